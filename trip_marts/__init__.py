"""Trip analytics on Spark: monthly batches to staging, fact and marts."""
