"""Localized catalog analytics and corpus operators on Spark DataFrames."""
