"""Questions that the catalog answers, as DataFrames."""
