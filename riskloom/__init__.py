"""Credit-risk features, streams, training sets and reports on Spark DataFrames."""
