"""Analyses: DataFrame in, DataFrame out."""
