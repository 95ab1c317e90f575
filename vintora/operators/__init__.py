"""Loan-book calculations; every function takes and returns lazy DataFrames."""
