"""Readers that build panels and indicator tables, and partitioned sinks."""
