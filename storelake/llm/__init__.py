"""Operators of the training-data pipeline. Nothing else in the library imports this package."""
