"""Structured Streaming forms of the weekly bucket."""
