"""Order-flow analytics and corpus preparation on Spark DataFrames."""
