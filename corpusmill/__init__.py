"""corpusmill: text-corpus preparation and analysis on Spark DataFrames."""
