"""Batch analytics over trip records, written as plain Spark DataFrame operators."""
