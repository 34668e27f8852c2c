"""Declared schemas, readers and writers."""
