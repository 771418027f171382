"""Typed tables, test-data views, JSON text and result sinks."""
