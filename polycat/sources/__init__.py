"""Datasets, dimension files and reports."""
