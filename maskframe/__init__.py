"""Label-image analytics on Spark."""
