"""Loads from a source to a sink, their command line, and the queries that exercise them."""
