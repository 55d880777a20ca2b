"""Table operators: each function takes DataFrames and returns a lazy DataFrame."""
