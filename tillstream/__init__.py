"""Point-of-sale event analytics on Spark: decode, deduplicate, window, merge, check."""
