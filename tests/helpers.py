"""Small helpers for tests."""


def rows(df, *cols):
    """Result rows as tuples, in a stable order."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
