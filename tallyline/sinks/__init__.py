"""File sinks."""
