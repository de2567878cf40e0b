"""Training-data operators on Spark DataFrames (text dedup, tokenisation, filters, language model)."""
