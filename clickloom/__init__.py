"""Advertising events to campaign metrics, on Spark DataFrames."""

__version__ = "0.1.0"
