"""Corpus, retrieval and evaluation operators for Spark DataFrames."""
