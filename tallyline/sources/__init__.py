"""Readers for landed pages, id lists and generated products."""
