"""Lectern: document and question-bank analytics on Spark DataFrames."""
