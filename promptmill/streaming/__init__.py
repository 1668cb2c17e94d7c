"""Structured Streaming: prompt requests and arriving chat files."""
