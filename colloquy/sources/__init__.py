"""Readers, dimensions and sinks."""
