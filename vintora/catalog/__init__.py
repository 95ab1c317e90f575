"""Registered queries, their oracle SQL and the mapping of the test tables to a loan book."""
