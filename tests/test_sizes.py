"""What one task holds, and what is read anew, as tables grow."""

import gzip
import re
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from idtrail import session
from idtrail.operators import cardinality as K, joins as J, labels as L, sssom as S
from idtrail.plans import profiles as P
from idtrail.queries import releases as R, scanning as Q
from idtrail.session import RELEASE, staged
from idtrail.sinks import tables as W
from idtrail.sources import records


def test_a_range_of_an_export_has_its_limit(spark, tmp_path, monkeypatch):
    df = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("subject_id"), (F.col("id") % 7).cast("string").alias("object_id"))
    told = []
    for limit in (10**6, 100):
        monkeypatch.setattr(W, "FILE_ROWS", limit)
        W.write_sssom(df, str(tmp_path / str(limit)), S.SetMetadata(provider="P"), 3)
        parts = [p.read_bytes() for p in sorted((tmp_path / str(limit)).glob("part-*"))]
        told.append(b"".join(parts))
    assert told[0] == told[1] and len(parts) > 3
    assert max(len(p.splitlines()) for p in parts) < 500


def test_compressed_parts_are_the_same_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "work_folder", lambda spark: str(tmp_path / f"work-{uuid.uuid4().hex}"))
    df = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 900).alias("subject_id"), (F.col("id") % 7).cast("string").alias("object_id"))
    told = []
    for files, codec in ((3, None), (3, "gzip"), (None, "gzip")):
        done, path = [], tmp_path / f"{files}-{codec}"
        W.write_sssom(staged(df), str(path), S.SetMetadata(provider="P"), files, codec, read=lambda: done.append(path.exists()))
        parts = [p.read_bytes() for p in sorted(path.glob("part-*"))]
        told.append(b"".join(map(gzip.decompress, parts) if codec else parts))
        assert done == [not files]  # the rows may go before a sorted export is written
    assert told[0] == told[1] and sorted(told[2].splitlines()) == sorted(told[0].splitlines()) and len(told[0].splitlines()) == 3004
    assert not list(tmp_path.glob("work-*"))


def test_exports_leave_the_disk_when_their_digests_are_there(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_ROWS", 300)
    for module in (W, R, session):
        monkeypatch.setattr(module, "work_folder", lambda spark: str(tmp_path / f"work-{uuid.uuid4().hex}"))
    lines = spark.range(2000).selectExpr("id % 700 AS l_orderkey", "id % 311 AS l_partkey", "IF(id % 50 = 0, NULL, id % 3) AS l_suppkey")
    lines.unionAll(lines.limit(40)).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = R.stable_export(spark, str(tmp_path))
    told = rows(got)
    assert [r[0] for r in told] == [1, 2, 3, 4] and all(a == b for _, a, b in told)
    files = [p for p in tmp_path.glob("work-*/**/part-*")]
    assert files and sum(p.stat().st_size for p in files) < 20_000 and not list(tmp_path.glob("work-*/*.gz")) + list(tmp_path.glob("work-*/*.txt"))


def test_only_counts_above_one_are_looked_up(spark, rows):
    made = [(f"p{i}", f"s{i}") for i in range(50)] + [("p1", "t1"), ("p2", "s3"), ("p2", "s3"), (None, "s1"), ("p4", None), ("Entry Withdrawn", "s5"), ("Entry Withdrawn", "w")]
    df, seen = spark.createDataFrame(made, "primaryID string, secondaryID string"), []

    def stage(table):
        seen.append((table.columns[1], table.count()))
        return staged(table)

    got = rows(K.describe_mappings(df, note_retired=False, stage=stage), "primaryID", "secondaryID", K.CLASS)
    assert got == rows(K.describe_mappings(df, note_retired=False), "primaryID", "secondaryID", K.CLASS)
    assert seen == [("__fan_in", 2), ("secondaryID", 55), ("__fan_out", 2)]
    classes = Counter(c for *_, c in got)
    assert classes == {"1:1": 46, "n:1": 3, "n:n": 2, "1:n": 2, "1:0": 2, None: 2}


def test_what_was_shuffled_for_a_table_leaves_the_disk(spark, rows):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if f.getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(RELEASE, None)
    df = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    table = staged(df)
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(RELEASE, None) == setting
    assert rows(table) == rows(df) and len(rows(table)) == 7


def test_files_grow_in_number_with_the_table(spark):
    small, large = spark.range(0, 9, 1, 1).selectExpr("'x' || id AS value"), spark.range(0, 9000, 1, 12).selectExpr("'x' || id AS value")
    assert [Q._several(df).rdd.getNumPartitions() for df in (small, large)] == [3, 12]
    lines = spark.read.text(Q._framed(large, F.col("value"), "head\n", "tail\n"))
    assert lines.where("value = 'head'").count() == 12 and lines.count() == 9024


def test_documents_of_a_chunk_come_together(spark, rows, tmp_path):
    from zipfile import ZipFile

    with ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(40):
            z.writestr(f"{i}.xml", str(i))
    names = {"path": f"file:{tmp_path}/a.zip", "names": [f"{i}.xml" for i in range(40)]}
    import pandas as pd

    frames = list(records._read_entries(iter([pd.DataFrame([names])])))
    assert len(frames) == 1 and list(frames[0]["value"]) == [str(i) for i in range(40)]


def test_archives_are_written_by_several_tasks(spark, tmp_path):
    made = spark.range(0, 400, 1, 1).selectExpr("'H' || id AS primaryID", "'<x/>' AS value").unionAll(spark.range(0, 5).selectExpr("'H0'", "'<x/>'"))
    dealt = Q._for_files(made.coalesce(1), "primaryID").sortWithinPartitions("primaryID")
    paths = [r.path for r in dealt.mapInPandas(Q._archiver(f"file:{tmp_path}"), "path string").collect()]
    assert len(paths) == len(set(paths)) > 4


def test_distinct_mappings_are_made_once(spark, rows):
    made = [("a", "x", "n", "s"), ("a", "y", "n", "s"), ("b", "x", "m", None), ("b", "x", "m", None), ("c", "", "k", "t")]
    df = spark.createDataFrame(made, "primaryID string, secondaryID string, name string, synonym string")
    seen = []

    def stage(table):
        seen.append(table.count())
        return staged(table)

    assert rows(S.sssom_of_redirects(df, stage=stage)) == rows(S.sssom_of_redirects(df))
    assert seen == [3]


EDGES = [  # target, old id, old symbol: hot, retired, withdrawn, copied and missing ones
    ("a", "x", "X"), ("a", "y", None), ("a", "y", "Y"), ("b", "a", "A2"), ("b", "a", "A1"), ("c", "b", None), ("d", "b", "B"), (None, "n", "N"),
    ("e", None, "E"), ("e", "x", "X"), ("f", "e", None), ("y", None, "S"), ("g", "f", "F"), ("Entry Withdrawn", "c", "C"), ("Entry Withdrawn", "x", "X"),
    ("Entry Withdrawn", "d", None), ("n", "g", "G"), ("n", "g", "G"),
]


def edges_and_symbols(spark):
    edges = spark.createDataFrame(EDGES, "primaryID string, secondaryID string, secondarySymbol string")
    current = spark.createDataFrame([("a", "GA2"), ("a", "GA"), ("b", None), ("d", "GD"), (None, "GN"), ("z", "GZ")], "primaryID string, s string")
    return edges, current


@pytest.mark.parametrize("noted", [True, False])
def test_symbols_are_chosen_where_targets_are_counted(spark, rows, noted):
    edges, current = edges_and_symbols(spark)
    parts = [K.describe_mappings(edges, note_retired=noted, facts=L.current_symbols(edges, current, chosen=c)) for c in (True, False)]
    want, got = [rows(p, "primaryID", "secondaryID", "secondarySymbol", "primarySymbol", K.CLASS, "comment") for p in parts]
    assert got == want and len(got) == len(EDGES)
    symbols = {r[0]: r[3] for r in got}
    assert symbols == {"a": "GA", "b": "B", "c": "C", "d": "GD", "e": None, "f": "F", "g": "G", "n": "N", "y": "Y", None: None, "Entry Withdrawn": None}
    assert sum("also withdrawn" in (r[5] or "") for r in got) == (12 if noted else 0)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if re.search(r"[ -]Exchange (hash|Round|Single|range)", x) and "ReusedExchange" not in x]


@pytest.fixture
def plain_plans(spark):
    """No broadcast, and the plan as it is before it runs."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def ncbi_tables(spark, **options):
    taxon = F.lit("9606").alias("#tax_id")
    history = spark.range(300).selectExpr(
        "if(id % 3 = 0, '-', 'g' || id) AS GeneID", "'o' || id AS Discontinued_GeneID", "if(id % 3 = 1, 'b', 'S' || id) AS Discontinued_Symbol", "'-' AS Discontinue_Date")
    info = spark.range(300).selectExpr("'g' || id AS GeneID", "'G' || id AS Symbol", "if(id % 9 = 0, 'N', '-') AS Symbol_from_nomenclature_authority", "'N|b|b' AS Synonyms")
    return P.ncbi(history.select(taxon, "*"), info.select(taxon, "*"), "v1", **options)


def test_a_mapping_set_of_genes_takes_few_shuffles(spark, plain_plans, tmp_path):
    tables = ncbi_tables(spark)
    assert len(shuffles(tables["mappings"])) <= 6  # one aggregation by target, one by old id, two joins
    folders = {k: staged(tables[k], str(tmp_path / k)) for k in ("mappings", "labels")}
    out = P.mapping_set("NCBI", folders)
    assert len(shuffles(out)) <= 5  # mappings, label rows, which are made distinct before, and the distinct keys of mappings
    assert out.count() == 800


def test_aliases_are_not_shuffled_for_few_nomenclature_symbols(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = ncbi_tables(spark, stage=lambda df: staged(df, str(tmp_path / "stored")))["labels"]
        assert len(shuffles(stored)) == 2  # to make rows distinct, and of the nomenclature symbols
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert stored.where("comment like '%is the nomenclature symbol%'").count() == 300 and stored.count() == 600
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_full_join_of_few(spark, rows):
    left = spark.createDataFrame([("1", None, "a"), ("1", None, "b"), ("1", "x", "c"), (None, None, "d"), ("3", "z", "e"), (None, "x", "f")], "k string, l string, a string")
    right = spark.createDataFrame([("1", None, "A"), ("1", None, "B"), (None, None, "C"), ("2", "y", "D"), ("2", "y", "D"), ("x", None, "E")], "k string, l string, b string")
    got = J.full_join_few(left, right, ["k", "l"])
    assert got.columns == J.full_join(left, right, ["k", "l"]).columns == ["k", "l", "a", "b"]
    assert rows(got) == rows(J.full_join(left, right, ["k", "l"])) and got.count() == 11
    assert rows(J.full_join_few(left, left.withColumnRenamed("a", "b"), ["k", "l"])) == rows(J.full_join(left, left.withColumnRenamed("a", "b"), ["k", "l"]))
