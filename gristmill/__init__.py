"""gristmill: a corpus preparation engine on Spark DataFrames."""
