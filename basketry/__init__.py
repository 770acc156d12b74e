"""basketry: recommendation-data jobs on Spark DataFrames."""
