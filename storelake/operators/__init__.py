"""Relational and analytic operators, each ``DataFrame -> DataFrame``."""
