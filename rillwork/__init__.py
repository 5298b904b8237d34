"""Record linkage and training-data processing on Spark DataFrames."""
