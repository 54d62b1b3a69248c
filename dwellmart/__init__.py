"""Property-listing analytics on Spark: curate raw listings, load a star schema, report on it."""
