"""Warehouse building blocks for PySpark: plain functions from DataFrames to DataFrames."""
