"""Queries over the benchmark tables and the SQL their results must equal."""
