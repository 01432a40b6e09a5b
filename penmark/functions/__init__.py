"""Column-expression building blocks (no Python workers)."""
