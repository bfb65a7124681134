"""Scoring newly arriving texts with Structured Streaming."""
