"""segflow: road-traffic count analytics on Spark DataFrames."""
