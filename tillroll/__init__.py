"""Retail customer analytics expressed as Spark DataFrame functions."""
