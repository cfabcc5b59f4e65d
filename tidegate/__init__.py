"""Change-data pipelines as plain Spark DataFrame functions."""
