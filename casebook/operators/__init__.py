"""Set-wise operators: DataFrames in, DataFrames out."""
