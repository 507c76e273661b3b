"""Names, symbols, aliases and synonyms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators.cardinality import RETIRED, split_withdrawn
from idtrail.operators.joins import flag_member, grouped, lookup


def with_primary_symbol(
    df: DataFrame, symbol: str, authority: str, out: str = "primarySymbol", missing: Sequence[str] = V.MISSING
) -> DataFrame:
    """``symbol|authority`` where the naming authority uses another symbol, else ``symbol``.

    ``missing``, here and below: what the source writes for no value. ``NA`` is a symbol in some sources.
    """
    s, a = F.col(symbol), C.null_if(F.col(authority), missing)
    return df.withColumn(out, F.when(a != s, F.concat_ws("|", s, a)).otherwise(s))


def nomenclature_symbols(df: DataFrame, symbol: str, authority: str, missing: Sequence[str] = V.MISSING) -> DataFrame:
    """Distinct authority symbols that differ from the symbol in use; the dash is not one."""
    a = C.null_if(F.col(authority), missing)
    return df.where(a != F.col(symbol)).select(a.alias("symbol")).distinct()


def explode_list(
    df: DataFrame, column: str, out: str, separator: str = "|", keep_empty: bool = False, missing: Sequence[str] = V.MISSING
) -> DataFrame:
    """One row per list part, other columns repeated; with ``keep_empty`` a NULL row for no part."""
    parts = C.split_list(C.null_if(F.col(column), missing), separator)
    rest = [c for c in df.columns if c not in (column, out)]
    return df.select(*[F.col(f"`{c}`") for c in rest], _explode(parts, keep_empty).alias(out))


def _explode(parts, keep_empty: bool):
    return F.explode_outer(parts) if keep_empty else F.explode(parts)


def explode_typed_aliases(
    df: DataFrame,
    aliases: str,
    nomenclature: DataFrame,
    release: str | None = None,
    out: str = "secondarySymbol",
    keep_empty: bool = False,
    unique: bool = False,
    missing: Sequence[str] = V.MISSING,
) -> DataFrame:
    """One row per alias; its comment says whether the alias is the authority's symbol of any gene.

    ``unique`` drops repeated rows, before the comment makes them long.
    """
    rows = explode_list(df, aliases, out, keep_empty=keep_empty, missing=missing)
    rows = flag_member(rows.distinct() if unique else rows, nomenclature, out, "__own")
    text = F.when(F.col("__own"), V.NOMENCLATURE_COMMENT).otherwise(V.UNOFFICIAL_COMMENT)
    if release is not None:
        text = F.concat(text, C.release_note(release))
    return rows.withColumn("comment", F.when(F.col(out).isNotNull(), text)).drop("__own")


def explode_commented_list(
    df: DataFrame, column: str, comment: str, out: str = "secondarySymbol"
) -> DataFrame:
    """One row per list part with a fixed comment; a row without label and comment for no part."""
    rows = explode_list(df, column, out, keep_empty=True)
    return rows.withColumn("comment", F.when(F.col(out).isNotNull(), comment))


def merge_label_tables(
    previous: DataFrame, alias: DataFrame, key: str = "primaryID", label: str = "secondarySymbol"
) -> DataFrame:
    """Both label tables as one set; label-less rows go where their id has a label elsewhere."""
    rows = previous.unionByName(alias)
    labelled = rows.where(F.col(label).isNotNull())
    bare = rows.where(F.col(label).isNull()).distinct()
    # Distinct label-less rows are few per id, so a plain anti join has no hot key.
    lone = bare.join(labelled.select(key).distinct(), key, "left_anti")
    return labelled.distinct().unionByName(lone.select(*labelled.columns))


def explode_targets(df: DataFrame, targets: str, separator: str = ", ") -> DataFrame:
    """One row per ``id|symbol|status`` target, split into primaryID, primarySymbol and status."""
    rows = explode_list(df, targets, "__target", separator)
    target = F.col("__target")
    return rows.withColumns(
        {
            "primaryID": C.triple_id(target),
            "primarySymbol": C.triple_symbol(target),
            "status": C.triple_status(target),
        }
    ).drop("__target")


def with_target_status_note(df: DataFrame, status: str = "status", target: str = "primaryID") -> DataFrame:
    """Adds the retired-target note to the comment of rows whose target has that status."""
    gone = (F.col(status) == V.WITHDRAWN) & (F.col(target) != V.WITHDRAWN)
    note = F.concat(F.col("comment"), F.lit(V.TARGET_RETIRED_NOTE))
    return df.withColumn("comment", F.when(gone, note).otherwise(F.col("comment")))


def explode_synonyms(
    df: DataFrame,
    name: str = "name",
    synonyms: str = "synonyms",
    key: str = "primaryID",
    keep_empty: bool = False,
) -> DataFrame:
    """(id, name, synonym) rows from an array; ``keep_empty`` keeps a name without synonym."""
    parts = F.filter(F.col(synonyms), lambda x: F.trim(x) != "")
    return df.select(key, F.col(name).alias("name"), _explode(parts, keep_empty).alias("synonym"))


def explode_secondaries(df: DataFrame, secondary: str = "secondary", key: str = "primaryID") -> DataFrame:
    parts = F.filter(F.col(secondary), lambda x: F.trim(x) != "")
    return df.select(key, F.explode(parts).alias("secondaryID"))


def current_symbols(
    mappings: DataFrame,
    current: DataFrame,
    secondary: str = "secondaryID",
    retired_symbol: str = "secondarySymbol",
    key: str = "primaryID",
    out: str = "primarySymbol",
    chosen: bool = True,
) -> DataFrame:
    """One symbol per id: of the ``current`` (id, symbol) table, else the one it was retired with.

    Without ``chosen``, the rows it is chosen from, one at least for every old id: ``RETIRED`` tells which they are. An
    aggregation by id that is made anyway can choose then (:func:`describe_mappings`).
    """
    usable = F.col(out).isNotNull()
    names = current.toDF(key, out).withColumn(RETIRED, F.lit(False)).where(usable)
    own = mappings.select(F.col(secondary).alias(key), F.col(retired_symbol).alias(out), F.lit(True).alias(RETIRED))
    both = names.unionByName(own).where(F.col(key).isNotNull())
    if not chosen:
        return both
    return grouped(both.where(usable), [key]).agg(F.min(F.struct(RETIRED, out))[out].alias(out)).drop("__apart")


def with_current_symbol(
    df: DataFrame,
    current: DataFrame,
    primary: str = "primaryID",
    secondary: str = "secondaryID",
    retired_symbol: str = "secondarySymbol",
    out: str = "primarySymbol",
) -> DataFrame:
    """Symbol of each target: current table, else its own retired symbol, else NULL.

    A withdrawn target is its own symbol.
    """
    live, gone = split_withdrawn(df, primary)
    table = current_symbols(df, current, secondary, retired_symbol, primary, out)
    live = lookup(live, table, [primary])
    return live.unionByName(gone.withColumn(out, F.lit(V.WITHDRAWN)))


def primary_ids(df: DataFrame, columns: Sequence[str] = ("primaryID",)) -> DataFrame:
    return df.select(*columns).distinct()
