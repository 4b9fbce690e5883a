"""Composite queries and pipeline stages built from hourcast operators."""
