"""Line dedup by winnowing: minima of windows of line hashes as fingerprints, joined, extended both ways, later runs deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import unused
from idtrail.session import staged

BLANK = " \t\u000b\f\r"


def _lines(text: Column) -> Column:
    """Lines that hold more than blanks: place among all lines and the line without blanks at its ends."""
    placed = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(BLANK)).alias("line")))
    return F.filter(placed, lambda s: s.line != "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once for each row, however many lambdas read it."""
    return F.get(F.transform(F.array(value), use), 0)


def fingerprints(docs: DataFrame, run: int = 2, alone: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, body, hash, n, first, around, at`` for each line of ``docs`` that is the minimum of some window.

    A window is ``run`` lines in a row, or a line of at least ``alone`` words by itself. Lines that hold more than blanks are numbered
    from 1; ``n`` is the line's number, ``at`` the numbers of the windows that it is the (leftmost) minimum of, 0 for the window of one
    line. ``around`` holds the hashes from line ``first`` on, of the line and of up to ``run - 1`` lines on both sides.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lined = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), _lines(text).alias("lines"))
    hashes = F.transform("lines", lambda s: F.unhex(F.md5(s.line)))
    enough = F.transform("lines", lambda s: F.size(F.split(s.line, f"[{BLANK}]+")) >= alone)
    none = F.array().cast("array<int>")

    def of_line(hashes: Column, single: Column, i: Column) -> Column:
        n, last = i + 1, F.size(hashes) - run + 1
        low, high = F.greatest(F.lit(1), n - run + 1), F.least(n, last)

        def chosen(k: Column) -> Column:
            window = F.slice(hashes, k, run)
            return F.array_position(window, F.array_min(window)) == n - k + 1

        windows = F.filter(F.when(low <= high, F.sequence(low, high)).otherwise(none), chosen)
        return F.struct(
            F.get(hashes, i).alias("hash"), n.alias("n"), low.alias("first"), F.slice(hashes, low, n - low + run).alias("around"),
            F.concat(F.when(single, F.array(F.lit(0))).otherwise(none), windows).alias("at"),
        )

    minima = _bound(hashes, lambda h: F.filter(F.transform(enough, lambda x, i: of_line(h, x, i)), lambda p: F.size(p["at"]) > 0))
    return lined.select("doc_id", "body", F.explode(minima).alias("p")).select("doc_id", "body", "p.*")


def repeats(docs: DataFrame, run: int = 2, alone: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, body, runs``: maximal runs of lines (``start, length``, numbered from 1 among lines that hold more than blanks) that a
    window covers which stands earlier as well. A row for each document that has some.

    1. Fingerprints: two places with the same window have its minimum in common, so only minima are kept and joined by their hash;
       those that stand at one place only go.
    2. Extension: a shared fingerprint grows both ways by the line hashes around it to the windows that chose it. A window that an
       earlier place has as well is a match.
    3. Matches of a document that touch or overlap are one run.
    4. Earlier is the smaller id, null last, then the smaller line. Counts and firsts combine before their shuffles; joins with
       them read them as tables, so a line that a third of all documents holds can be split.
    """
    spot = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "n")
    found = staged(fingerprints(docs, run, alone, id_col, text_col))
    shared = staged(found.groupBy("hash").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).where(~F.col("a").eqNullSafe(F.col("b"))).select("hash"))
    seeds = found.join(shared, "hash", "left_semi").select("doc_id", "body", "hash", "n", "first", "around", F.explode("at").alias("k"))
    one = F.col("k") == 0
    grown = seeds.select(
        "doc_id", "body", F.when(one, F.col("n")).otherwise(F.col("k")).alias("n"), F.when(one, 1).otherwise(run).alias("length"),
        F.when(one, F.col("hash")).otherwise(F.concat(*[F.get("around", F.col("k") - F.col("first") + j) for j in range(run)])).alias("window"),
    )
    grown = staged(grown)
    first = staged(grown.groupBy("window").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first < last").select("window", "first"))
    later = grown.join(first, "window").where(spot > F.col("first"))
    # repeated rows of a document say the same
    spans = later.groupBy("doc_id", "body").agg(F.sort_array(F.collect_set(F.struct("n", "length"))).alias("spans"))
    return spans.select("doc_id", "body", _merged(F.col("spans")).alias("runs"))


def _merged(spans: Column) -> Column:
    """Spans as runs: those that touch or overlap become one. Time grows with the lines, not with their square."""
    numbers = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["n"], s["n"] + s["length"] - 1)))))

    def runs(n: Column) -> Column:
        starts = F.filter(n, lambda x, i: F.coalesce(F.get(n, i - 1) < x - 1, F.lit(True)))
        ends = F.filter(n, lambda x, i: F.coalesce(F.get(n, i + 1) > x + 1, F.lit(True)))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("length")))

    return _bound(numbers, runs)


def dedup_lines(docs: DataFrame, run: int = 2, alone: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line deleted that lies in a repeated run and not in its first place; all rows and columns stay.

    A repeated run is ``run`` or more lines in a row, or one line of ``alone`` or more words, that also stands in a document
    of a smaller id or earlier in the same one; judged on the input. Blank lines neither count nor go, blanks at a line's ends
    don't matter. Words are what blanks part.

    Null text stays null. Null id: later than any id; rows without id don't take from each other (nor do rows of one id) unless
    the run stands further down. Repeated rows lose the same lines. Empty table: no rows. ``docs`` may hold columns of any other names.
    """
    gone_id, gone_body, runs = (unused(docs, x) for x in ("gone_id", "gone_body", "runs"))
    gone = repeats(docs, run, alone, id_col, text_col).select(
        F.col("doc_id").alias(gone_id), F.col("body").alias(gone_body), F.col("runs").alias(runs)
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col(gone_id)) & (F.xxhash64(text) == F.col(gone_body)), "left")

    def without(places: Column) -> Column:
        return F.flatten(F.transform(F.col(runs), lambda r: F.slice(places, r["start"], r["length"])))

    def left(parts: Column) -> Column:
        lost = _bound(F.transform(_lines(text), lambda s: s["at"]), without)
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), lost), lambda i: F.get(parts, i)), "\n")

    kept = _bound(F.split(text, "\n"), left)
    return joined.select(
        *[F.when(F.col(runs).isNull(), F.col(text_col)).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    )


def digest(docs: DataFrame, run: int = 2, alone: int = 5) -> DataFrame:
    """``doc_id, n_lines, n_removed`` (lines that are not blank) and ``kept_sha256`` for each row of ``docs``."""
    both = dedup_lines(docs.select("doc_id", "text", F.col("text").alias("whole")), run, alone)
    n = F.size(_lines(F.coalesce("whole", F.lit("")))).cast("long")
    left = F.size(_lines(F.coalesce("text", F.lit("")))).cast("long")
    return both.select("doc_id", n.alias("n_lines"), (n - left).alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
