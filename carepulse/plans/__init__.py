"""Table-level plans: raw to silver to gold, serving queries, materialised runs."""
