"""Structured Streaming form of the running balance."""
