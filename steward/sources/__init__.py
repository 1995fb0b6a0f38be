"""Readers, table declarations and sinks."""
