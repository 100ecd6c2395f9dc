"""Structured Streaming: the live half, with the batch operators' semantics."""
