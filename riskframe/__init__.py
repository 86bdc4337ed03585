"""Policy-portfolio analytics on Spark DataFrames."""
