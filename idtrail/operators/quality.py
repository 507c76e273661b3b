"""Checks on inputs and on finished tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from idtrail.functions import vocab as V
from idtrail.operators.cardinality import split_withdrawn
from idtrail.operators.joins import anti_join, flag_member


def failed_extracts(lines: DataFrame, file: str = "file", text: str = "value", mark: str = V.FAILED_EXTRACT) -> DataFrame:
    """Files with at least one line that holds the failure mark, and how many such lines."""
    hits = lines.where(F.col(text).contains(mark))
    return hits.groupBy(file).agg(F.count("*").alias("n_marks"))


def reject_failed_extracts(lines: DataFrame, file: str = "file", text: str = "value", mark: str = V.FAILED_EXTRACT) -> DataFrame:
    """Lines of the files that hold no failure mark at all."""
    return anti_join(lines, failed_extracts(lines, file, text, mark), [file])


def membership_counts(values: DataFrame, column: str, others: DataFrame, check: str) -> DataFrame:
    """(check, outcome, n): how many rows have their value in ``others`` and how many do not."""
    flagged = flag_member(values.select(column), others, column, "__in")
    counts = flagged.groupBy("__in").agg(F.count("*").alias("n"))
    return counts.select(F.lit(check).alias("check"), F.col("__in").cast("string").alias("outcome"), "n")


def all_match(df: DataFrame, column: str, pattern: str, check: str) -> DataFrame:
    """One row (check, outcome): whether every row matches the pattern, and the row count."""
    bad = F.count_if(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))
    outcome = F.when(bad == 0, "true").otherwise("false")
    return df.agg(F.lit(check).alias("check"), outcome.alias("outcome"), F.count("*").alias("n"))


def orphan_labels(mappings: DataFrame, labels: DataFrame, symbol: str = "primarySymbol") -> DataFrame:
    """Mappings whose target symbol is neither a current nor an old symbol of the label table."""
    known = labels.select(F.col("primarySymbol").alias(symbol)).union(labels.select("secondarySymbol"))
    live, _ = split_withdrawn(mappings, symbol)
    return anti_join(live.where(F.col(symbol).isNotNull()), known, [symbol])


CLASSES = "^(1:1|n:1|1:n|n:n|1:0)$"


def unclassed() -> Column:
    """Aggregate: rows without one of the five classes."""
    return F.count_if(~F.coalesce(F.col("mapping_cardinality").rlike(CLASSES), F.lit(False)))


def quality_report(mappings: DataFrame, labels: DataFrame, counted: Mapping[str, int] | None = None) -> DataFrame:
    """(check, outcome, n) rows: row counts, membership tables, class check and orphan symbols.

    Each table is read once: its rows become keys with what they say about them, which one aggregation by key brings together.
    ``counted`` holds what was observed when the tables were written (``mapping_rows``, ``unclassed``, ``label_rows``).
    """
    gone = F.coalesce(F.col("primaryID") == V.WITHDRAWN, F.lit(False))
    live_symbol = F.col("primarySymbol").isNotNull() & (F.col("primarySymbol") != V.WITHDRAWN)
    said = [
        _fact("id", F.col("primaryID"), target=1),
        _fact("id", F.when(gone, F.col("secondaryID")), n=gone.cast("int")),
        _fact("symbol", F.when(live_symbol, F.col("primarySymbol")), n=live_symbol.cast("int")),
    ]
    known = [_fact("id", F.col("primaryID"), label=1), *(_fact("symbol", F.col(c), label=1) for c in ("primarySymbol", "secondarySymbol"))]
    if counted is None:
        bad = (~F.coalesce(F.col("mapping_cardinality").rlike(CLASSES), F.lit(False))).cast("int")
        said.append(_fact("rows", F.lit("mapping"), n=1, bad=bad))
        known.append(_fact("rows", F.lit("label"), n=1))
    facts = mappings.select(F.inline(F.array(*said))).unionByName(labels.select(F.inline(F.array(*known))))
    by_key = facts.groupBy("kind", "key").agg(*[F.max(c).alias(c) for c in ("target", "label")], *[F.sum(c).alias(c) for c in ("n", "bad")])

    def total(test: Column, what: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(what))), F.lit(0))

    ids, has = F.col("kind") == "id", {c: (F.col(c) == 1) & F.col("key").isNotNull() for c in ("target", "label")}
    rows = {k: F.lit(v) for k, v in (counted or {}).items()} or {
        f"{k}_rows": total((F.col("kind") == "rows") & (F.col("key") == k)) for k in ("mapping", "label")
    } | {"unclassed": total(F.col("kind") == "rows", "bad")}
    sums = by_key.agg(
        *[total(ids & (has[c] if yes else ~has[c])).alias(f"{c}_{yes}") for c in has for yes in (True, False)],
        total((F.col("kind") == "symbol") & F.col("key").isNotNull() & ~has["label"]).alias("orphans"),
        *[x.cast("long").alias(name) for name, x in rows.items()],
    )
    none = F.lit(None).cast("string")
    lines = [
        *[(check, F.lit(str(yes).lower()), F.nullif(F.col(f"{c}_{yes}"), F.lit(0)))
          for c, check in (("target", "withdrawn id is a target"), ("label", "withdrawn id has labels")) for yes in (True, False)],
        ("every mapping has a class", F.when(F.col("unclassed") == 0, "true").otherwise("false"), F.col("mapping_rows")),
        ("mapping rows", none, F.col("mapping_rows")), ("label rows", none, F.col("label_rows")), ("orphan target symbols", none, F.col("orphans")),
    ]
    told = F.array(*[F.struct(F.lit(check).alias("check"), outcome.alias("outcome"), n.cast("long").alias("n")) for check, outcome, n in lines])
    return sums.select(F.inline(told)).where("n is not null")


def _fact(kind: str, key: Column, **values) -> Column:
    """What a row says about a key."""
    own = {"target": 0, "label": 0, "n": 0, "bad": 0} | values
    told = [(v if isinstance(v, Column) else F.lit(v)).alias(c) for c, v in own.items()]
    return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), *told)
