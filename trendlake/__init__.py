"""Batch and incremental lakehouse for trending-content statistics, on Spark DataFrames."""
