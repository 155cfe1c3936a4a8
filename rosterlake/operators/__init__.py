"""DataFrame operators: each takes and returns DataFrames, nothing is run until the caller acts."""
