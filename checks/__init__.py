"""Queries on the shared test tables and the SQL they are checked against."""
