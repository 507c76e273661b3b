"""Differences of tables and of builds. Rows are equal if all columns are, NULL with NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

REPEATS = 4096
CODED = 32


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def repeated(df: DataFrame, n: str) -> DataFrame:
    """Each row as often as its column ``n`` says, without that column; no array grows beyond the square root of a large ``n``."""
    rest = [f"`{c}`" for c in df.columns if c != n]
    full = F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / REPEATS)))
    parts = df.where(F.col(n) > 0).select(*rest, n, full.alias("__part"))
    own = F.least(F.lit(REPEATS), F.col(n) - F.col("__part") * REPEATS).cast("int")
    return parts.select(*rest, F.explode(F.array_repeat(F.lit(True), own)).alias("__one")).drop("__one")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less those of ``right``, as bags: ``n`` copies less ``m`` leave ``n - m``. Columns go by name.

    One shuffle of sums that tasks have made before, so a row with many copies moves once per task.
    """
    signed = left.select(*_columns(left), F.lit(1).alias("__n")).unionByName(right.select(*_columns(left), F.lit(-1).alias("__n")))
    return repeated(signed.groupBy(*_columns(left)).agg(F.sum("__n").alias("__n")), "__n")


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; the same one shuffle."""
    sides = left.select(*_columns(left), F.lit(1).alias("__side")).unionByName(right.select(*_columns(left), F.lit(2).alias("__side")))
    return sides.groupBy(*_columns(left)).agg(F.bit_or("__side").alias("__side")).where("__side = 1").drop("__side")


def build_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = ("primaryID", "secondaryID"), value: str = "mapping_cardinality",
) -> DataFrame:
    """What became of each row from one build to the next: ``keys, change, old_<value>, new_<value>, n_old, n_new``.

    ``change`` is ``gone``, ``come``, ``changed`` (another set of values) or ``same``. Values of several rows of a key are joined by ``|``;
    a key's rows differ in few values, so sets stay small. NULL keys are keys, a NULL value counts as empty text.

    The values are looked up first, so give stored tables. Up to ``CODED`` different ones, as classes are, are added up as bits of a number,
    which takes no sort and no objects; more are collected.
    """
    names = [f"`{k}`" for k in keys]

    def side(df: DataFrame, mark: int) -> DataFrame:
        return df.select(*names, F.coalesce(F.col(value).cast("string"), F.lit("")).alias("__value"), F.lit(mark).alias("__side"))

    def of(mark: int, what):
        return F.when(F.col("__side") == mark, what)

    both = side(old, 0).unionByName(side(new, 1))
    values = [r[0] for r in both.select("__value").distinct().sort("__value").limit(CODED + 1).collect()] or [""]
    sums = [F.count(of(0, F.lit(1))).alias("n_old"), F.count(of(1, F.lit(1))).alias("n_new")]
    if len(values) <= CODED:
        bits = [F.lit(1 << i).cast("long") for i in range(len(values))]
        unknown = F.raise_error(F.lit("a value that was not there when the values were looked up"))
        code = F.coalesce(*[F.when(F.col("__value") == v, bit) for v, bit in zip(values, bits, strict=True)], unknown)
        coded = both.select(*names, "__side", *[of(mark, code).otherwise(F.lit(0).cast("long")).alias(f"__{mark}") for mark in (0, 1)])
        told = coded.groupBy(*names).agg(F.bit_or("__0").alias("__0"), F.bit_or("__1").alias("__1"), *sums)
        texts = [F.concat_ws("|", *[F.when(F.col(c).bitwiseAND(bit) != 0, F.lit(v)) for v, bit in zip(values, bits, strict=True)]) for c in ("__0", "__1")]
    else:
        told = both.groupBy(*names).agg(*[F.collect_set(of(mark, F.col("__value"))).alias(f"__{mark}") for mark in (0, 1)], *sums)
        texts = [F.array_join(F.sort_array(c), "|") for c in ("__0", "__1")]
    told = told.select(*names, texts[0].alias(f"old_{value}"), texts[1].alias(f"new_{value}"), "n_old", "n_new")
    change = F.when(F.col("n_new") == 0, "gone").when(F.col("n_old") == 0, "come").when(F.col(f"old_{value}") != F.col(f"new_{value}"), "changed")
    return told.withColumn("change", change.otherwise("same"))
