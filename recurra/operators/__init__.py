"""Table-level operators: DataFrames in, lazy DataFrames out."""
