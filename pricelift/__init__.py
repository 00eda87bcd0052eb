"""Retail price analytics as Spark DataFrame plans."""
