"""Readers: raw files, archives and sample catalogues as DataFrames."""
