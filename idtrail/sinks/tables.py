"""Stage tables as Parquet, exports as text."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from idtrail.functions import clean as C
from idtrail.operators.changes import repeated
from idtrail.operators.sssom import SetMetadata, header_lines, single_source
from idtrail.session import remove_folder, shuffles_released, staged, work_folder


def write_table(df: DataFrame, path: str) -> None:
    """The canonical form: Parquet, which the next stage prunes and splits."""
    df.write.mode("overwrite").parquet(path)


def tsv_line(df: DataFrame) -> Column:
    """All columns of a row as one tab-separated line; NULL is empty, tabs and line ends are blanks."""
    cells = [F.coalesce(C.one_line(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns]
    return F.concat_ws("\t", *cells)


def write_tsv(df: DataFrame, path: str, names: Mapping[str, str] | None = None) -> None:
    """Tab-separated text whose part files, in name order, form one file with one header.

    ``names`` renames columns for the export only.
    """
    df = df.withColumnsRenamed(dict(names or {}))
    _write_lines([], df, path)


FILE_ROWS = 250_000


def in_order(df: DataFrame, files: int, folder: str | None = None) -> DataFrame:
    """``df`` in ``files`` ranges of rows, sorted by all columns: one after the other they are the same sequence for any number of them.

    Ranges of more than some ``FILE_ROWS`` rows are cut further, all alike, so that no task sorts a fixed share of a large table. Equal rows are counted first and repeated behind the sort, so many copies of a row don't meet in one sort.
    The counted rows are stored in ``folder``, for they are read twice: where the ranges end is sampled first.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = staged(df.groupBy(*columns).agg(F.count("*").alias("__n")), folder, "zstd")
    cuts = -(-df.count() // (files * FILE_ROWS))
    return repeated(counted.repartitionByRange(files * max(cuts, 1), *columns).sortWithinPartitions(*columns), "__n")


def write_sssom(
    df: DataFrame, path: str, meta: SetMetadata, files: int | None = None, compression: str | None = None, read: Callable[[], None] | None = None
) -> None:
    """Mapping set with its metadata header, in the same layout as :func:`write_tsv`.

    A source that all rows share moves to the header. ``df`` is read twice; hand it a stored table. With ``files`` the rows are
    sorted into at most so many part files, or a multiple of it (see :func:`in_order`): part files joined in name order are the same
    bytes for any number of them. With ``compression`` (``gzip``) each part file is compressed by itself, which takes a fifth of the room.
    ``read`` is called when ``df`` is not needed any more, which with ``files`` is before the export is written.
    """
    before, after = header_lines(meta)
    source = single_source(df)
    shared = [f'# source: "{source}"', "#"] if source is not None else []
    gap = [""] if meta.comment else []
    rows = df.drop("source") if shared else df
    head = [*before, *shared, *after, *gap]
    read, counted = read or (lambda: None), None
    try:
        if files:
            counted = work_folder(df.sparkSession)
            rows = in_order(rows, files, counted)
            read()
        _write_lines(head, rows, path, compression)
        if not files:
            read()
    finally:
        if counted:
            remove_folder(df.sparkSession, counted)


def write_observed(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Writes ``df`` as a table and returns the values of the aggregates ``counts``, taken from the rows as they were written.

    They are observed in the tasks that write, each of which counts once however often it is tried; nothing is read again.
    """
    seen = Observation(f"write-{uuid.uuid4().hex}")
    write_table(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), path)
    return seen.get


def _write_lines(head: list[str], df: DataFrame, path: str, compression: str | None = None) -> None:
    # A union keeps the order of its parts: the header is the first part file, the rows follow in
    # as many part files as there are tasks. No sort and no single writer is needed.
    text = "\n".join([*head, "\t".join(df.columns)])
    first = df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1)
    rows = df.select(tsv_line(df).alias("value"))
    with shuffles_released(df.sparkSession):
        first.union(rows).write.mode("overwrite").option("zlib.compress.level", "BEST_SPEED").text(path, compression=compression)


def write_xref_graph(
    path: str, nodes: DataFrame, links: DataFrame, attributes: DataFrame, info: DataFrame
) -> None:
    for name, df in {"nodes": nodes, "links": links, "attributes": attributes, "info": info}.items():
        write_table(df, f"{path.rstrip('/')}/{name}")
