"""Readers: landed files in, flat DataFrames out."""
