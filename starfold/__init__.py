"""starfold: star schemas built and queried with Spark DataFrames."""
