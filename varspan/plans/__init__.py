"""Registered queries and the views they read."""
