"""Readers for landed data and partitioned sinks."""
