"""Secret scan over all versions of files, each content scanned once per rule version. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import unused
from idtrail.session import staged

# The base rules. (kind, version, pattern, group whose length counts, least length, what masking puts there)
RULES = (
    (
        "assign", 1,
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 8,
    ),
    # a run that is too short can't hold a longer one, so the least length may stand in the pattern
    ("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", 1, "[0-9a-f]{32,}", 0, 32),
)
SPAN = "struct<start:bigint,end:bigint>"
LEDGER = f"blob string, kind string, version int, spans array<{SPAN}>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _spans(gaps: Column, found: Column, values: Column, least: int) -> Column:
    """Where the matches lie (code points, end exclusive): each match follows one gap."""
    parts = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own"))),
        values, lambda p, v: F.struct(p.gap.cast("long").alias("gap"), p.own.cast("long").alias("own"), (F.length(v) >= least).alias("good")),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin, end = acc.at + x.gap, acc.at + x.gap + x.own
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x.good, F.concat(acc.out, span)).otherwise(acc.out).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc.out)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES, text_col: str = "text") -> DataFrame:
    """Ledger rows ``blob, kind, version, spans`` for each pair of a content and a rule version that ``ledger`` lacks.

    A content is named by its SHA-256, so all copies and all historical versions with the same text are scanned once, and a
    later run scans only new texts, or old ones by new rule versions. A content without findings has a row too: it was seen.
    Null text counts as empty. Copies are merged before the shuffle (partial aggregation), a hot one is a row a task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blobs = versions.select(blob_id(F.col(text_col)).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    name = F.concat_ws(":", "kind", F.col("version").cast("string"))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(name).alias("seen"))  # at most one entry for each rule version
        blobs = blobs.join(seen, "blob", "left")
    else:
        blobs = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
    blobs = blobs.withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    rows = []
    for kind, version, pattern, group, least in rules:
        gaps, found, values = f"gaps_{kind}", f"found_{kind}", f"values_{kind}"
        due = ~F.array_contains("seen", f"{kind}:{version}")
        blobs = blobs.withColumn(gaps, F.when(due, F.split("text", pattern, -1)))
        hit = F.size(gaps) > 1
        blobs = blobs.withColumn(found, F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))).withColumn(
            values, F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))) if group else F.col(found)
        )
        spans = F.when(hit, _spans(F.col(gaps), F.col(found), F.col(values), least)).otherwise(F.array().cast(f"array<{SPAN}>"))
        rows.append(F.when(due, F.struct(F.lit(kind).alias("kind"), F.lit(version).alias("version"), spans.alias("spans"))))
    blobs = blobs.select("blob", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("row"))
    return blobs.select("blob", "row.kind", "row.version", "row.spans")


def by_path(versions: DataFrame, ledger: DataFrame, rules=RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``path, spans`` for every row of ``versions``: findings of its content, sorted by start and then the rule's place.

    The ledger has a row per content, the versions side holds the hot contents; Spark may split it.
    """
    wanted = F.create_map(*[x for k, (kind, version, *_) in enumerate(rules) for x in (F.lit(f"{kind}:{version}"), F.lit(k))])
    place = wanted[F.concat_ws(":", "kind", F.col("version").cast("string"))]
    flat = F.transform("spans", lambda s: F.struct(s.start.alias("start"), F.col("place").alias("place"), F.col("kind").alias("kind"), s.end.alias("end")))
    found = staged(ledger.withColumn("place", place).where("place is not null").groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list(flat))).alias("spans")  # one list for each rule
    ))  # as a table it has no partitioning that the join would keep, so Spark may split a hot content
    paths = versions.select(F.col(path_col).alias("path"), blob_id(F.col(text_col)).alias("blob"))
    return paths.join(found, "blob").select("path", "spans")


def digest(docs: DataFrame, ledger: DataFrame | None = None, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_<kind> .., base_sha256, spans`` for each row of ``docs``, over old and new ledger rows.

    Null or empty text: no spans. Null ids and repeated rows each come out. Empty table: no rows. Other columns are not read.
    """
    new = staged(scan(docs, ledger, rules, text_col))
    every = new if ledger is None else ledger.select("blob", "kind", "version", "spans").unionByName(new)
    listed = by_path(docs, every, rules, id_col, text_col)
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    counts = [
        F.size(F.filter(F.transform("spans", lambda s: s.kind), F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind, *_ in rules
    ]
    return listed.select(F.col("path").cast("long").alias("doc_id"), *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def redact(docs: DataFrame, mark: str = "<SECRET>", rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each found span replaced by ``mark``; overlapping spans are replaced as one. Texts without one stay.

    Findings join by content, so nothing depends on ids; other columns pass unchanged, whatever their names.
    """
    spans, blob = unused(docs, "spans"), unused(docs, "blob")
    ledger = staged(scan(docs, None, rules, text_col)).where(F.size("spans") > 0)
    found = staged(ledger.groupBy(F.col("blob").alias(blob)).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias(spans)))
    text = F.col(text_col)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        apart = s.start >= acc.at
        before = text.substr((acc.at + 1).cast("int"), F.greatest(s.start - acc.at, F.lit(0)).cast("int"))
        return F.struct(
            F.when(apart, F.concat(acc.out, before, F.lit(mark))).otherwise(acc.out).alias("out"), F.greatest(acc.at, s.end).alias("at")
        )

    masked = F.aggregate(spans, start, step, lambda acc: F.concat(acc.out, text.substr((acc.at + 1).cast("int"), F.lit(2**31 - 1))))
    return docs.join(found, blob_id(text) == F.col(blob), "left").select(
        *[F.when(F.col(spans).isNull(), text).otherwise(masked).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    )
