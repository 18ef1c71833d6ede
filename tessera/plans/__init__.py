"""Runs of several operators, their checks, and the catalogue of queries."""
