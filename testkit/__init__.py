"""Derived inputs, registered queries and their SQL counterparts for checking the engine."""
