"""Column-returning helpers; all stay inside whole-stage code generation."""
