"""Retail customer and sales analytics as Spark DataFrame operators."""
