"""Queries over the given tables, each with the SQL that it must agree with."""
