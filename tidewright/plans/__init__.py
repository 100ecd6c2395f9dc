"""Queries over the test tables: each operator in use, with its SQL twin."""
