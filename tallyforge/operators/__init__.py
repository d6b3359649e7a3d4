"""Batch operators over DataFrames."""
