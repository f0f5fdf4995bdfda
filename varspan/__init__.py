"""Variant-table and sequence operators as Spark DataFrame functions."""
