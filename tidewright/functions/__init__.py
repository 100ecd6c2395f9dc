"""Scalar expressions."""
