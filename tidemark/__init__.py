"""Time-anchored quality measures over event tables, on Spark DataFrames."""
