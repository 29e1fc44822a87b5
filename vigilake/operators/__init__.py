"""Operators on transactions, customers and watchlists: plain functions from DataFrames to DataFrames, for batch and streams alike."""
