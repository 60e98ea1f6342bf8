"""Normalise a nested media catalogue into relational tables with Spark DataFrames."""
