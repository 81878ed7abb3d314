"""Pressmill: document analytics on Spark DataFrames."""
