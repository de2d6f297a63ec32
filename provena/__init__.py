"""provena: evidence-first analytics on Spark DataFrames."""
