"""Column-level building blocks; every one returns a native Spark ``Column``."""
