"""Readers and writers of every dataset, with explicit schemas."""
