"""cairn: building, curating and auditing a concept corpus with Spark DataFrames."""
