"""Growth analytics on Spark: who grows unusually fast for their size, and where to see them."""
