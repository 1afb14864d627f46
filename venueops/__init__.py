"""Table-level Spark operators for venue operations: DataFrames in, DataFrames out."""
