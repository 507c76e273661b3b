"""Whole sources: which operators make which tables."""
