"""Query-tuning operators on Spark DataFrames."""
