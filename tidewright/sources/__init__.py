"""Readers and writers of the raw feed, stored tables and archives."""
