"""Retail stock-out monitoring and replenishment on PySpark DataFrames."""
