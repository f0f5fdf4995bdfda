"""Operators on variant tables: DataFrame in, DataFrame out."""
