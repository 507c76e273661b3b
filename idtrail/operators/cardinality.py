"""Classify old-to-current mappings and describe each class.

All withdrawn mappings share one target, so they are set apart first: their class is a constant
and they never take part in a shuffle on the target.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators.joins import flag_member, grouped, lookup, with_group_count

CLASS = "mapping_cardinality"
PREDICATE = "predicateID"
RETIRED = "__retired"


def split_withdrawn(
    df: DataFrame, primary: str = "primaryID", withdrawn: str = V.WITHDRAWN
) -> tuple[DataFrame, DataFrame]:
    """(live rows, withdrawn rows); rows with a NULL target count as live."""
    gone = F.col(primary).eqNullSafe(withdrawn)
    return df.where(~gone), df.where(gone)


def with_cardinality(
    df: DataFrame,
    primary: str = "primaryID",
    secondary: str = "secondaryID",
    withdrawn: str = V.WITHDRAWN,
    out: str = CLASS,
) -> DataFrame:
    """Class of every row: 1:1, n:1, 1:n, n:n, or 1:0 for a withdrawn target.

    The fan-in of a target counts live rows; the fan-out of an old id counts all rows, withdrawn
    ones too. A row that lacks one of its two ids is no mapping: it counts nothing and has no class.
    """
    live, gone = split_withdrawn(df, primary, withdrawn)
    live = _classified(live, df, primary, secondary, out, withdrawn)
    return live.unionByName(gone.withColumn(out, F.lit(V.ONE_TO_NONE)))


def _classified(live, everything, primary, secondary, out, withdrawn, retired=False, facts=None, stage=None) -> DataFrame:
    """Live rows with their class, with ``__retired`` (the target is an old id itself) and the columns of ``facts``, see
    :func:`describe_mappings`.

    The rows are shuffled twice: by target, which brings the fan-in, the flag and the facts, all from one aggregation, and by
    old id, which brings the fan-out. Ids that no live row asks for go no further than their aggregation, nor do counts of one, which need
    no looking up. ``stage`` stores the counts, and the rows between the two.
    """
    asking = F.col(primary).isNotNull()
    whole = asking & F.col(secondary).isNotNull()
    told = live.where(asking).select(F.col(primary), F.col(secondary).isNotNull().cast("int").alias("__fan_in"))
    sums = [F.sum("__fan_in").alias("__fan_in")]
    extra = [c for c in facts.columns if c not in (primary, RETIRED)] if facts is not None else []
    ranked = facts is not None and RETIRED in facts.columns
    if extra:
        chosen = F.struct(*extra)
        if ranked:
            chosen = F.when(reduce(Column.__or__, [F.col(c).isNotNull() for c in extra]), F.struct(RETIRED, *extra))
        columns = [primary, RETIRED] if ranked else [primary]
        told = told.unionByName(facts.select(*columns, chosen.alias("__facts")), allowMissingColumns=True)
        sums.append(F.min("__facts").alias("__facts"))
    if retired and not ranked:
        old = everything.dropna(subset=[secondary]).select(F.col(secondary).alias(primary), F.lit(True).alias(RETIRED))
        told = told.unionByName(old, allowMissingColumns=True)
    if retired:
        sums.append(F.bool_or(RETIRED).alias(RETIRED))
    targets = grouped(told, [primary]).agg(*sums).where(F.col("__fan_in").isNotNull()).drop("__apart")
    if not extra and not retired:
        targets = targets.where("__fan_in > 1")
    if extra:
        targets = targets.select("*", *[F.col(f"__facts.{c}").alias(c) for c in extra]).drop("__facts")
    olds = everything.where(whole).select(F.col(secondary), (~F.col(primary).eqNullSafe(withdrawn)).alias("__live"))
    olds = grouped(olds, [secondary]).agg(F.count("*").alias("__fan_out"), F.bool_or("__live").alias("__live"))
    olds = olds.where("__live AND __fan_out > 1").drop("__apart", "__live")
    if stage:
        live, olds = stage(lookup(live, stage(targets), [primary])), stage(olds)
        return _labelled(lookup(live, olds, [secondary]), whole, out)
    return _labelled(lookup(lookup(live, targets, [primary]), olds, [secondary]), whole, out)


def _labelled(rows: DataFrame, whole: Column, out: str) -> DataFrame:
    label = F.concat(_n_or_one("__fan_in"), F.lit(":"), _n_or_one("__fan_out"))
    return rows.withColumn(out, F.when(whole, label)).drop("__fan_in", "__fan_out")


def _one_or_n(count: str) -> Column:
    return F.when(F.col(count) > 1, "n").when(F.col(count) == 1, "1")


def _n_or_one(count: str) -> Column:
    """Of a count that is looked up where it is above one."""
    return F.when(F.col(count) > 1, "n").otherwise("1")


def with_group_size(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows with the size of their ``key`` group, the NULL group included.

    Same result as ``count(*) over (partition by key)``, without one task per group.
    """
    return with_group_count(df, key, out, null_safe=True)


def with_list_cardinality(
    df: DataFrame,
    targets: str,
    separator: str = ", ",
    withdrawn: str = V.WITHDRAWN,
    out: str = CLASS,
) -> DataFrame:
    """Class of rows that hold their whole target list as text, before it is exploded.

    Several targets give 1:n. Otherwise rows with the same target text are counted: one gives 1:1,
    more give n:1. The n:n class cannot occur in this form.
    """
    text = F.col(targets)
    many = text.contains(separator)
    single = df.where(~many & (text != withdrawn))
    fixed = df.where(many | (text == withdrawn) | text.isNull())
    single = with_group_count(single, targets, "__fan_in")
    single = single.withColumn(out, F.concat(_one_or_n("__fan_in"), F.lit(":1"))).drop("__fan_in")
    label = F.when(many, V.ONE_TO_MANY).when(text == withdrawn, V.ONE_TO_NONE)
    return single.unionByName(fixed.withColumn(out, label))


def predicate_of(label: str = CLASS) -> Column:
    """``consider`` for split or withdrawn ids, ``replaced by`` for one current id."""
    return F.when(F.col(label).isin(*V.CONSIDER_CLASSES), V.CONSIDER).when(
        F.col(label).isin(*V.REPLACED_CLASSES), V.REPLACED_BY
    )


def comment_of(label: str = CLASS) -> Column:
    chosen = F.lit(None).cast("string")
    for name, text in V.CLASS_COMMENTS.items():
        chosen = F.when(F.col(label) == name, text).otherwise(chosen)
    return chosen


def date_prefix(date: str) -> Column:
    """Opening of a comment, empty where the source gives no date."""
    date = F.col(date)
    return F.when(date.isNotNull(), F.concat(F.lit(V.DATE_PREFIX), date, F.lit(". "))).otherwise("")


def with_predicate(df: DataFrame, label: str = CLASS, out: str = PREDICATE) -> DataFrame:
    return df.withColumn(out, predicate_of(label))


def with_comment(
    df: DataFrame,
    label: str = CLASS,
    date: str | None = None,
    retired: str | None = None,
    release: str | None = None,
    out: str = "comment",
) -> DataFrame:
    """Comment of the class; date prefix, retired-target note and release stamp where asked for."""
    parts = [date_prefix(date)] if date else []
    parts.append(comment_of(label))
    if retired:
        parts.append(F.when(F.col(retired), V.TARGET_RETIRED_NOTE).otherwise(""))
    if release is not None:
        parts.append(C.release_note(release))
    return df.withColumn(out, F.concat(*parts))


def flag_retired_target(
    df: DataFrame,
    primary: str = "primaryID",
    secondary: str = "secondaryID",
    withdrawn: str = V.WITHDRAWN,
    out: str = "target_retired",
) -> DataFrame:
    """Whether the target of a row is itself an old id of this table."""
    live, gone = split_withdrawn(df, primary, withdrawn)
    live = flag_member(live, df.select(secondary), primary, out)
    return live.unionByName(gone.withColumn(out, F.lit(False)))


def describe_mappings(
    df: DataFrame,
    primary: str = "primaryID",
    secondary: str = "secondaryID",
    date: str | None = None,
    release: str | None = None,
    withdrawn: str = V.WITHDRAWN,
    note_retired: bool = True,
    facts: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Class, predicate and comment of every mapping, with one split into live and withdrawn rows.

    The columns of ``facts``, a table with one row per target id, are attached on the way; they
    are NULL for withdrawn rows. With a column ``RETIRED`` it may have several rows per id, from which the least of those that
    say false is taken, else the least of the others; then it has a row that says true for every old id of ``df``, and the ids
    need not be collected again. ``stage`` stores the counts, and the rows between the two lookups, so that the shuffles of one step
    at a time are on disk.
    """
    live, gone = split_withdrawn(df, primary, withdrawn)
    live = _classified(live, df, primary, secondary, CLASS, withdrawn, note_retired, facts, stage)
    gone = gone.withColumn(CLASS, F.lit(V.ONE_TO_NONE))
    rows = live.unionByName(gone, allowMissingColumns=True)
    rows = with_comment(with_predicate(rows), CLASS, date, RETIRED if note_retired else None, release)
    return rows.drop(RETIRED)


def append_withdrawn(
    live: DataFrame,
    deleted: DataFrame,
    secondary: str = "secondaryID",
    release: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """Described live mappings plus one withdrawn mapping per deleted id."""
    rows = deleted.select(
        F.lit(V.WITHDRAWN).alias("primaryID"),
        F.col(secondary).alias("secondaryID"),
        F.lit(V.ONE_TO_NONE).alias(CLASS),
    )
    rows = with_comment(with_predicate(rows), release=release)
    rows = rows.withColumn("source", F.lit(source).cast("string"))
    return live.unionByName(rows, allowMissingColumns=True)
