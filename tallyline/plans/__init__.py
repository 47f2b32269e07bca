"""Derived input tables, the query catalogue and its SQL counterparts."""
