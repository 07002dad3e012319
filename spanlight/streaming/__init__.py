"""Streaming jobs: the batch operators driven by Structured Streaming."""
