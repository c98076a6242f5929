"""lakemart: retail lake-loading and analytics jobs on Spark DataFrames."""

__version__ = "0.1.0"
