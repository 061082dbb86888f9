"""Operators over DataFrames: checks, quality steps and summaries."""
