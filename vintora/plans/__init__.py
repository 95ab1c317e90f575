"""Wiring of the operators into whole runs."""
