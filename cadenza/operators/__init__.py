"""Operators over episodes: plain functions from DataFrames to DataFrames."""
