"""Structured Streaming ingestion of landed meter files."""
