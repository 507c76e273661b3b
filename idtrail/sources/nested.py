"""Records of XML files cut by depth: an end tag in a comment, in character data or of a nested element ends no record."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.session import staged
from idtrail.sources.records import XML_ROW, xml_documents

TEXT, COMMENT, DATA, INSTRUCTION = range(4)
BEGIN = {"<!--": COMMENT, "<![CDATA[": DATA, "<?": INSTRUCTION}
END = {COMMENT: "-->", DATA: "]]>", INSTRUCTION: "?>"}
SUMMARY = "path string, block long, ends array<int>"
ENTRY = "path string, block long, state int, depth int, opened_in long, leaves_open boolean"


def marks_of(row_tag: str) -> re.Pattern:
    """What matters in plain text: the beginnings of other states, and start tags of the record that are not empty elements."""
    attributes = r"""(?:"[^"]*"|'[^']*'|[^"'/>]|/(?!>))*"""
    tag = re.escape(row_tag)
    return re.compile(rf"<!--|<!\[CDATA\[|<\?|<{tag}(?=[\s>])(?!\s{attributes}/>)")


def walk(text: str, state: int, marks: re.Pattern) -> tuple[int, list[int]]:
    """The state behind ``text``, and where start tags stand in it."""
    at, starts = 0, []
    while True:
        if state != TEXT:
            end = text.find(END[state], at)
            if end < 0:
                return state, starts
            at, state = end + len(END[state]), TEXT
        found = marks.search(text, at)
        if not found:
            return state, starts
        at = found.end()
        if found[0] in BEGIN:
            state = BEGIN[found[0]]
        else:
            starts.append(found.start())


def chunks(spark: SparkSession, path, row_tag: str) -> DataFrame:
    """(path, block, value): text between end tags, in the order of the file within each split, which ``block`` names by its offset."""
    text = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _summaries(row_tag: str) -> Callable:
    """For each split and each state it may begin in: the state behind it, and what it does to the depth.

    A depth ``d`` becomes ``max(d + change, floor)``, and on the way it was as low as ``d + lowest``.
    """
    out = pa.schema([("path", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int32()))])

    def told(key, ends) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": key[0], "block": key[1], "ends": [x for end in ends for x in end]}], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, key, ends = marks_of(row_tag), None, []
        for batch in batches:
            for path, block, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (path, block) != key:
                    if key:
                        yield told(key, ends)
                    key, ends = (path, block), [(state, 0, 0, 0) for state in range(4)]
                walked = {state: walk(text, state, marks) for state in {end[0] for end in ends}}
                ends = [_after(end, *walked[end[0]]) for end in ends]
        if key:
            yield told(key, ends)

    return run


def _after(end: tuple[int, int, int, int], state: int, starts: list[int]) -> tuple[int, int, int, int]:
    _, change, floor, lowest = end
    change, floor = change + len(starts), floor + len(starts)
    if state == TEXT:
        change, floor = change - 1, max(0, floor - 1)
    return state, change, floor, min(lowest, change)


def _entries(splits: pd.DataFrame) -> pd.DataFrame:
    """State and depth at the beginning of each split of one file, and the split in which the record that is open there began."""
    state, depth, opened, rows = TEXT, 0, None, []
    for path, block, ends in splits.sort_values("block")[["path", "block", "ends"]].itertuples(index=False):
        entry = state, depth, opened
        state, change, floor, lowest = (int(x) for x in ends[4 * state : 4 * state + 4])
        if depth + lowest <= 0:
            opened = block
        depth = max(depth + change, floor)
        if not depth:
            opened = None
        rows.append((path, block, *entry, depth > 0))
    found = pd.DataFrame(rows, columns=[c.split()[0] for c in ENTRY.split(", ")])
    return found.astype({"opened_in": "Int64"})


def _records(row_tag: str) -> Callable:
    """Records; those that go over the bounds of a split as pieces, with the split in which they began."""
    end_tag = f"</{row_tag}>"
    out = pa.schema([("path", pa.string()), ("opened_in", pa.int64()), ("block", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, key, parts, state, depth, opened = marks_of(row_tag), None, [], TEXT, 0, None
        for batch in batches:
            rows = []
            for path, block, text, *entry in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (path, block) != key:
                    if parts:
                        rows.append((key[0], key[1] if opened is None else opened, key[1], "".join(parts)))
                    key, parts = (path, block), []
                    state, depth, opened = entry
                state, starts = walk(text, state, marks)
                if depth:
                    parts += [text, end_tag]
                elif starts:
                    parts = [text[starts[0] :], end_tag]
                depth += len(starts)
                if state == TEXT and depth:
                    depth -= 1
                    if not depth:
                        rows.append((path, opened, block, "".join(parts)))
                        parts, opened = [], None
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, row, strict=True)) for row in rows], schema=out)
        if parts:
            rest = key[0], key[1] if opened is None else opened, key[1], "".join(parts)
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, rest, strict=True))], schema=out)

    return run


def record_texts(spark: SparkSession, path, row_tag: str = XML_ROW) -> DataFrame:
    """(value): each outermost ``row_tag`` element of the XML files at ``path``, whole, from its start tag on.

    The text is cut at end tags in parallel splits, as :func:`~idtrail.sources.records.scan_xml` does, but a cut ends a record only
    where the element is closed: not in a comment, in character data or an instruction, and not where a nested element of the same
    name ends. A start tag there begins none. Empty elements (``<row_tag/>``) are no records.

    Two passes read the files. The first tells for each split what it does to state and depth, whatever they are where it begins; put
    together in the order of a file (a row of numbers for each split) that gives state and depth at each beginning, which the second
    pass starts from. That table is broadcast: it has one row for each split, so about 100 bytes for 128 MB. Only records that
    go over the bounds of a split are shuffled, as pieces.

    Both passes must see the same splits; where these changed (by more or fewer executors), the job ends with a message.
    An end tag is one without blanks, and a file that ends within a record counts as if the end tag followed.
    """
    text = chunks(spark, path, row_tag)
    summaries = text.mapInArrow(_summaries(row_tag), SUMMARY)
    entries = staged(summaries.groupBy("path").applyInPandas(_entries, ENTRY))
    known = text.join(F.broadcast(entries), ["path", "block"], "left")
    message = "other splits than in the first pass: set spark.sql.files.minPartitionNum and run again"
    state = F.when(F.col("state").isNull(), F.raise_error(F.lit(message)).cast("int")).otherwise(F.col("state"))
    known = known.select("path", "block", "value", state.alias("state"), "depth", "opened_in", "leaves_open")
    schema = "path string, opened_in long, block long, value string"

    def read(rows: DataFrame) -> DataFrame:
        return rows.select("path", "block", "value", "state", "depth", "opened_in").mapInArrow(_records(row_tag), schema)

    whole = read(known).where("opened_in is null").select("value")
    pieces = read(known.where("depth > 0 or leaves_open")).where("opened_in is not null")
    joined = pieces.groupBy("path", "opened_in").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
    return whole.unionByName(joined.select(F.array_join("parts.value", "").alias("value")))


def scan_xml_by_depth(spark: SparkSession, path, row_tag: str = XML_ROW, strict: bool = True) -> DataFrame:
    """Records as :func:`~idtrail.sources.records.scan_xml` gives them, cut by :func:`record_texts`."""
    return xml_documents(record_texts(spark, path, row_tag), strict=strict)
