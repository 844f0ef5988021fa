"""Mart jobs: every function takes DataFrames and parameters and returns a lazy DataFrame."""
