"""Column expressions and column-level frame helpers."""
