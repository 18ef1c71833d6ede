"""Corpus reconciliation, cleaning, validation and retrieval operators on Spark DataFrames."""
