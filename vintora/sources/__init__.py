"""Readers, normalisation jobs, staging and result sinks."""
