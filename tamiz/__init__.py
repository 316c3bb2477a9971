"""Data-quality, profiling and cleaning operators for a Bronze -> Silver lakehouse, on Spark DataFrames."""
