"""Joins and counts that stay even when one key holds a large part of all rows.

Adaptive execution splits a skewed partition of a join if both sides of the join are plain shuffles: of an inner join on
both sides, of a left, semi or anti join on the left, of a full join not at all. Two things follow:

* **Aggregates keep apart.** A table that was grouped by the join key is not shuffled again, and then nothing can be split.
  :func:`grouped` therefore groups by the key and a hash of it: the same groups, but a partitioning that the join does not
  accept. The table, one row per key by then, is shuffled once more and the many rows on the other side can be split.
* **Completed sides.** Outer joins with many rows per key on both sides are inner joins: each side first gets one empty row
  per key that only the other side has.

There are no thresholds: what is hot shows at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.group import GroupedData


def grouped(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """Groups by ``keys``; the result has a column ``__apart`` more, see above. One bit of the hash does, and is shuffled with the keys."""
    columns = [F.col(f"`{k}`") for k in keys]
    return df.groupBy(*columns, F.xxhash64(*columns).bitwiseAND(1).alias("__apart"))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grouped(df, keys).agg(F.count("*").alias("__n")).select(*[f"`{k}`" for k in keys])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join with a ``table`` that has one row per key. With ``null_safe`` a NULL key matches a NULL key."""
    values = [c for c in table.columns if c not in keys]
    table = table.select(*[F.col(f"`{k}`").alias(f"__t{i}") for i, k in enumerate(keys)], *values)
    pairs = [(df[f"`{k}`"], table[f"__t{i}"]) for i, k in enumerate(keys)]
    return df.join(table, all_equal(pairs, null_safe), "left").select(*[f"`{c}`" for c in df.columns], *values)


def with_group_count(
    df: DataFrame, key: str, out: str, counted: DataFrame | None = None, null_safe: bool = False
) -> DataFrame:
    """``df`` with the number of rows of ``counted`` (default ``df``) that share its ``key``.

    NULL keys get NULL, or with ``null_safe`` the size of their own group.
    """
    counted = df if counted is None else counted
    counted = counted if null_safe else counted.dropna(subset=[key])
    return lookup(df, grouped(counted, [key]).agg(F.count("*").alias(out)).drop("__apart"), [key], null_safe)


def semi_join(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``other``."""
    return _by_keys(df, other, keys, null_safe, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``other``; NULL keys stay unless ``null_safe``."""
    return _by_keys(df, other, keys, null_safe, "left_anti")


def _by_keys(df, other, keys, null_safe, how) -> DataFrame:
    other = distinct_keys(other, keys).toDF(*[f"__t{i}" for i in range(len(keys))])
    return df.join(other, all_equal([(df[f"`{k}`"], other[f"__t{i}"]) for i, k in enumerate(keys)], null_safe), how)


def flag_member(df: DataFrame, values: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with a boolean telling whether ``column`` occurs in the one-column ``values``."""
    known = distinct_keys(values.toDF(column).dropna(), [column]).withColumn(out, F.lit(True))
    return lookup(df, known, [column]).withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join, many rows per key on both sides; a NULL key matches a NULL key."""
    sides = key_sides(left, right, keys)
    return _matches(completed(left, sides, _RIGHT), completed(right, sides, _LEFT), keys)


def full_join_few(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`full_join` for a ``right`` with few rows per key, where the left side alone can be hot.

    A left join, and the rows of ``right`` whose key ``left`` lacks. Both take ``right`` from one shuffle, for which its columns
    keep their names here; of ``left``, the distinct keys are shuffled beside the rows.
    """
    others = [c for c in right.columns if c not in keys]
    own = {k: f"__l{i}" for i, k in enumerate(keys)}
    pairs = [(F.col(own[k]), F.col(f"`{k}`")) for k in keys]
    rows = left.withColumnsRenamed(own).join(right, all_equal(pairs, True), "left")
    rows = rows.select(*[F.col(own[c]).alias(c) if c in own else F.col(f"`{c}`") for c in left.columns], *others)
    lone = anti_join(right, left.select(*keys), keys, null_safe=True)
    return rows.unionByName(lone, allowMissingColumns=True)


_LEFT, _RIGHT = 1, 2


def key_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both tables with the sides they occur on; one map-side combined shuffle."""
    keys = [f"`{k}`" for k in keys]
    tagged = left.select(*keys, F.lit(_LEFT).alias("__side"))
    tagged = tagged.union(right.select(*keys, F.lit(_RIGHT).alias("__side")))
    return tagged.groupBy(*keys).agg(F.bit_or("__side").alias("__side"))


def completed(df: DataFrame, sides: DataFrame, other: int = _LEFT) -> DataFrame:
    """``df`` plus an empty row for every key that only the ``other`` side has."""
    lacking = sides.where(F.col("__side") == other).drop("__side")
    return df.unionByName(lacking, allowMissingColumns=True)


def _matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in right.columns if c not in keys]
    right = right.select(*[F.col(f"`{k}`").alias(f"__r{i}") for i, k in enumerate(keys)], *others)
    pairs = [(left[k], right[f"__r{i}"]) for i, k in enumerate(keys)]
    return left.join(right, all_equal(pairs, True), "inner").select(*left.columns, *others)


def all_equal(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)
