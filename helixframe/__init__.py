"""helixframe: sequencing analytics on Spark DataFrames."""
