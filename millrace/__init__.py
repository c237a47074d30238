"""Millrace: transaction-pipeline analytics written as plain Spark jobs."""
