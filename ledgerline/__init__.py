"""Change-data-capture and corpus processing on Spark DataFrames."""
