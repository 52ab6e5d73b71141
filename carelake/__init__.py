"""Medallion analytics for appointment-style business data, on Spark DataFrames."""
