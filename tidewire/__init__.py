"""Analytics for gridded series, keyed sensor streams and mesh-routing reports on Spark DataFrames."""
