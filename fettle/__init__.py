"""Data profiling and entity cleaning over wide text tables, on Spark DataFrames."""
