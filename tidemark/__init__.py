"""Reporting and data-mart building blocks for Spark: plain functions from DataFrames to DataFrames."""
