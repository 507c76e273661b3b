"""Registered queries: every operator on the given tables, each with an independent SQL form."""

from importlib import import_module

from idtrail.queries.base import QUERIES, SQL

for _name in ("classify", "joining", "labelling", "cleaning", "scanning", "linking", "publishing", "releases", "manifests"):
    import_module(f"idtrail.queries.{_name}")

__all__ = ["QUERIES", "SQL"]
