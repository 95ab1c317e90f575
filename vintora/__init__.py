"""Loan-book validation, cohort and valuation jobs written as lazy Spark DataFrames."""

from vintora.params import Params

__all__ = ["Params"]
