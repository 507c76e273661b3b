"""Columns from nested documents by paths: one parse for all paths, inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from idtrail.sources.records import parsed_documents

STEP = re.compile(r"(@?[^\W\d][\w.-]*)(\[\])?")
TEXT = "_VALUE"


def parse_path(path: str) -> list[tuple[str, bool]]:
    """Steps of ``a/b[]/@c`` as (field, whether all of it are wanted); the last step may be an attribute."""
    steps = []
    for step in path.split("/"):
        found = STEP.fullmatch(step)
        if not found or steps and steps[-1][0].startswith("_") or step.startswith("@") and found[2]:
            raise ValueError(f"no path: {path!r}")
        steps.append((found[1].replace("@", "_", 1), bool(found[2])))
    return steps


def schema_of(paths: list[list[tuple[str, bool]]], colon: str = " ") -> str:
    """DDL of the fields that the paths need. An element is an array, as any may be repeated; an attribute is a text."""
    fields = {}
    for (name, _), *rest in paths:
        fields.setdefault(name, []).append(rest)

    def one(name: str, below: list) -> str:
        inner = [rest for rest in below if rest]
        if not inner:
            return "string" if name.startswith("_") else "array<string>"
        text = f"{TEXT}: string, " if len(inner) < len(below) else ""
        return f"array<struct<{text}{schema_of(inner, ': ')}>>"

    return ", ".join(f"`{name}`{colon}{one(name, below)}" for name, below in fields.items())


def _values(at: Column, steps: list[tuple[str, bool]], fields: list[list[tuple[str, bool]]]) -> Column:
    """What ``steps`` lead to from the struct ``at``; ``fields`` are all steps that any path takes from there."""
    (name, every), *rest = steps
    found = at.getField(name)
    if name.startswith("_"):
        return found
    below = [other for (field, _), *other in fields if field == name]
    nested = any(below)

    def of(node: Column) -> Column:
        if rest:
            return _values(node, rest, [b for b in below if b])
        return node.getField(TEXT) if nested else node

    if not every:
        return of(F.get(found, 0))
    inner = F.transform(found, of)
    if any(more for _, more in rest):
        inner = F.flatten(F.filter(inner, lambda x: x.isNotNull()))
    return inner


def xml_columns(documents: DataFrame, paths: Mapping[str, str], text: str = "value", strict: bool = True) -> DataFrame:
    """A column for each of ``paths``, read from a table with one XML document (or record) per row.

    A path leads down from the root: ``name``, ``taxonomy/kingdom``, ``proteins/protein[]/@id``. A step with ``[]`` takes all elements
    of that name, and the column is an array in document order (empty where there is none; repeated steps below repeated ones give one
    flat array); a step without takes the first. The last step may be ``@attribute``. Text is trimmed; empty text and an absent
    attribute are NULL, in arrays they are left out. Namespace prefixes of elements don't matter.

    All paths come from one parse, in which only their own fields are built. A malformed document ends the job, or without ``strict``
    is left out (:func:`~idtrail.sources.records.xml_rejects` tells which). A NULL document gives a row without values. Other columns
    of ``documents`` stay, before the new ones.
    """
    parsed = {name: parse_path(path) for name, path in paths.items()}
    clash = sorted({name.lower() for name in paths} & {c.lower() for c in documents.columns})
    if clash:
        raise ValueError(f"columns there already: {', '.join(clash)}")
    fields = list(parsed.values())
    read = parsed_documents(documents, schema_of(fields), text, strict, ignoreNamespace="true")

    def column(steps: list[tuple[str, bool]]) -> Column:
        found = _values(F.col("__parsed"), steps, fields)
        if not any(every for _, every in steps):
            return F.nullif(F.trim(found), F.lit(""))
        trimmed = F.transform(found, lambda x: F.trim(x))
        return F.coalesce(F.filter(trimmed, lambda x: x != ""), F.array().cast("array<string>"))

    return read.select(*[F.col(f"`{c}`") for c in documents.columns], *[column(steps).alias(name) for name, steps in parsed.items()])
