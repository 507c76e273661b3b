"""Ragged rows, versioned builds, differences, one-pass reports, ordered exports and files read by their content."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from idtrail.operators import changes as D, quality as Q
from idtrail.operators.sssom import SetMetadata
from idtrail.plans.build import publish
from idtrail.session import staged
from idtrail.sinks import versions as R
from idtrail.sinks.tables import write_observed, write_sssom
from idtrail.sources import tabular as T


def test_ragged_rows(spark, rows, tmp_path):
    (tmp_path / "a.tsv").write_text('a\tb\tc\n1\t2\t3\n4\n\n5\t6\t7\t8\n9\tx"y\t\n')
    path = str(tmp_path / "a.tsv")
    with pytest.raises(Exception, match="more than 3 cells: 5\t6\t7\t8"):
        T.scan_tsv(spark, path, ["c"]).collect()
    with pytest.raises(Exception, match="more than 3 cells"):
        T.scan_tsv(spark, path).count()
    assert rows(T.scan_tsv(spark, path, long_rows="reject")) == [("1", "2", "3"), ("4", None, None), ("9", 'x"y', None)]
    assert T.scan_tsv(spark, path, ["b"], long_rows="reject").count() == 3
    assert rows(T.tsv_rejects(spark, path), "line", "n_cells", "n_columns") == [("5\t6\t7\t8", 4, 3)]
    assert rows(T.tsv_rejects(spark, path, short_rows=True), "line") == [("4",), ("5\t6\t7\t8",)]
    with pytest.raises(ValueError):
        T.scan_tsv(spark, path, long_rows="drop")


def test_versions(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(FileNotFoundError):
        R.current(spark, root)
    first = R.write_version(spark, root, {"t": spark.range(3)})
    with pytest.raises(RuntimeError), R.building(spark, root) as folder:
        spark.range(9).write.parquet(f"{folder}/t")
        raise RuntimeError
    assert R.read_version(spark, root, "t").count() == 3 and len(list((tmp_path / "root" / "data").iterdir())) == 1
    # a commit that is still being written, or was never filled, does not count
    (tmp_path / "root" / "commits" / "0000000002").write_text("")
    assert R.current(spark, root) == first
    third = R.write_version(spark, root, {"t": spark.range(5)}, keep=1)
    assert third.number == 3 and R.versions(spark, root) == [third]
    spark.range(1).write.parquet(f"{root}/data/killed/t")
    assert R.expire(spark, root, orphan_hours=1) == [] and (tmp_path / "root" / "data" / "killed").exists()
    R.expire(spark, root, orphan_hours=0)
    assert [p.name for p in (tmp_path / "root" / "data").iterdir()] == [third.folder.rsplit("/", 1)[-1]]


def test_two_builds_take_two_numbers(spark, tmp_path):
    root = str(tmp_path / "root")
    with R.building(spark, root) as a, R.building(spark, root) as b:
        spark.range(1).write.parquet(f"{a}/t")
        spark.range(2).write.parquet(f"{b}/t")
    assert [(v.number, v.folder) for v in R.versions(spark, root)] == [(1, b), (2, a)]


def test_published_versions(spark, tmp_path):
    sdf, root = tmp_path / "x.sdf", str(tmp_path / "out")
    record = "mol\n> <ChEBI ID>\nCHEBI:{0}\n\n> <ChEBI Name>\nn{0}\n\n> <Secondary ChEBI ID>\nCHEBI:9{0}\n\n$$$$\n"
    sdf.write_text(record.format(1))
    publish(spark, "ChEBI", {"sdf": str(sdf)}, root, keep=2)
    sdf.write_text(record.format(1) + record.format(2))
    tables = publish(spark, "ChEBI", {"sdf": str(sdf)}, root, keep=2)
    with pytest.raises(Exception):
        publish(spark, "ChEBI", {"sdf": str(tmp_path / "absent")}, root, keep=2)
    assert tables["pri_ids"].count() == R.read_version(spark, root, "pri_ids").count() == 2
    assert [R.read_version(spark, root, "pri_ids", v).count() for v in R.versions(spark, root)] == [1, 2]


def test_differences(spark):
    rng = random.Random(1)
    left = [(rng.choice([None, 1, 2]), rng.choice([None, "a", "b"])) for _ in range(60)] + [(7, "x")] * 9000
    right = [(rng.choice([None, 1, 2]), rng.choice([None, "a", "b"])) for _ in range(40)] + [(7, "x")] * 10
    a, b = spark.createDataFrame(left, "k int, v string"), spark.createDataFrame(right, "k int, v string").select("v", "k")
    assert Counter(map(tuple, D.except_all(a, b).collect())) == Counter(left) - Counter(right)
    assert sorted(map(str, map(tuple, D.except_distinct(a, b.where("k = 1")).collect()))) == sorted(map(str, set(left) - {r for r in right if r[0] == 1}))
    assert D.except_all(a, a).isEmpty() and D.except_all(a.where("false"), b).isEmpty()
    # copies beyond one array
    many = spark.createDataFrame([(1, 2 * D.REPEATS + 1), (2, D.REPEATS), (3, 0), (4, -2)], "k int, n long")
    assert sorted(map(tuple, D.repeated(many, "n").groupBy("k").count().collect())) == [(1, 2 * D.REPEATS + 1), (2, D.REPEATS)]
    plan = D.except_all(a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_changes(spark):
    old = spark.createDataFrame([("p", "s", "1:1"), ("p", "t", "1:1"), (None, "u", None), ("q", "q", "n:1")], "primaryID string, secondaryID string, mapping_cardinality string")
    new = spark.createDataFrame([("p", "s", "1:n"), ("p", "s", "1:1"), (None, "u", None), ("r", "r", "1:0")], old.schema)
    got = {(r.primaryID, r.secondaryID): tuple(r)[2:] for r in D.build_changes(old, new).collect()}
    assert got == {
        ("p", "s"): ("1:1", "1:1|1:n", 1, 2, "changed"), ("p", "t"): ("1:1", "", 1, 0, "gone"), (None, "u"): ("", "", 1, 1, "same"),
        ("q", "q"): ("n:1", "", 1, 0, "gone"), ("r", "r"): ("", "1:0", 0, 1, "come"),
    }


def test_changes_of_few_and_many_values(spark):
    """Few values take no set objects and no sort; more than a number has bits are all told too."""
    rng = random.Random(4)
    schema = "primaryID string, secondaryID string, mapping_cardinality string"
    for kinds in (3, D.CODED, D.CODED + 1, 200):
        names = [None, "a|b", *map(str, range(kinds - 2))]
        sides = [[(rng.choice([None, "p", "q"]), str(rng.randrange(9)), rng.choice(names)) for _ in range(700)] for _ in range(2)]
        got = D.build_changes(*[spark.createDataFrame(rows, schema) for rows in sides])
        want = {}
        for k, rows in enumerate(sides):
            for *key, v in rows:
                sets = want.setdefault(tuple(key), [set(), set(), 0, 0])
                sets[k].add(v or "")
                sets[k + 2] += 1
        assert {tuple(r)[:2]: (r.old_mapping_cardinality, r.new_mapping_cardinality, r.n_old, r.n_new) for r in got.collect()} == {
            key: ("|".join(sorted(o)), "|".join(sorted(n)), a, b) for key, (o, n, a, b) in want.items()
        }
        assert ("ObjectHashAggregate" in got._jdf.queryExecution().executedPlan().toString()) == (kinds > D.CODED)
    none = spark.createDataFrame([], schema)
    assert D.build_changes(none, none).isEmpty()


def pair(spark):
    mappings = spark.createDataFrame(
        [("Entry Withdrawn", "1", None, "1:0"), ("Entry Withdrawn", None, None, "1:0"), ("1", "2", "A", "1:1"), ("3", "4", "B", None), (None, "5", "Entry Withdrawn", "x"), ("Entry Withdrawn", "9", "C", "1:0")],
        "primaryID string, secondaryID string, primarySymbol string, mapping_cardinality string")
    labels = spark.createDataFrame([("9", "A", "Z"), (None, None, "C")], "primaryID string, primarySymbol string, secondarySymbol string")
    return staged(mappings), staged(labels)


def test_report_reads_each_table_once(spark, rows):
    mappings, labels = pair(spark)
    counted = {"mapping_rows": 6, "unclassed": 2, "label_rows": 2}
    for given in (None, counted):
        report = Q.quality_report(mappings, labels, given)
        assert rows(report) == rows(spark.createDataFrame([
            ("withdrawn id is a target", "true", 1), ("withdrawn id is a target", "false", 2), ("withdrawn id has labels", "true", 1),
            ("withdrawn id has labels", "false", 2), ("every mapping has a class", "false", 6), ("mapping rows", None, 6), ("label rows", None, 2),
            ("orphan target symbols", None, 1)], "check string, outcome string, n long"))
        assert report._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    empty = Q.quality_report(mappings.where("false"), labels.where("false"))
    assert rows(empty) == [("every mapping has a class", "true", 0), ("label rows", None, 0), ("mapping rows", None, 0), ("orphan target symbols", None, 0)]


def test_counts_are_observed_while_writing(spark, tmp_path):
    mappings, _ = pair(spark)
    got = write_observed(mappings.repartition(4), str(tmp_path / "t"), mapping_rows=F.count(F.lit(1)), unclassed=Q.unclassed())
    assert got == {"mapping_rows": 6, "unclassed": 2} and spark.read.parquet(str(tmp_path / "t")).count() == 6


def exported(path):
    return b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_exports_are_the_same_bytes(spark, tmp_path):
    rng = random.Random(2)
    made = [(rng.choice([None, "a", "b"]), f"o{rng.randrange(300)}", rng.choice([None, "x\ty"])) for _ in range(500)] + [("c", "o", None)] * 5000
    df = spark.createDataFrame(made, "subject_id string, object_id string, comment string")
    told = []
    for files, dealt in ((1, df.repartition(7)), (3, df), (17, df.repartition(4, "object_id"))):
        write_sssom(dealt, str(tmp_path / str(files)), SetMetadata(provider="P"), files)
        told.append(exported(tmp_path / str(files)))
    assert told[0] == told[1] == told[2] and len(told[0].splitlines()) == 5500 + 4


@pytest.mark.parametrize("size", ["300b", "128m"])
def test_a_whole_file_by_its_content(spark, rows, tmp_path, size):
    made = [(f"s{i}" if i % 3 else "# note", f"o{i}" if i % 7 else None) for i in range(400)] + [("subject_id", "object_id"), ("#", "#")]
    df = spark.createDataFrame(made, "subject_id string, object_id string").withColumn("source", F.lit("u r l"))
    write_sssom(df, str(tmp_path / "parts"), SetMetadata(prefixes={"S": "http://s/"}, provider="P", comment="c d"), 3)
    (tmp_path / "set.tsv").write_bytes(exported(tmp_path / "parts") + b"short\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        meta, found = T.scan_sssom(spark, str(tmp_path / "set.tsv"))
        assert rows(found.select("object_id", "subject_id")) == sorted(((o, s) for s, o in [*made, ("short", None)]), key=lambda t: [(v is None, str(v)) for v in t])
        assert found.rdd.getNumPartitions() > 5 or size == "128m"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert meta["curie_map"] == {"S": "http://s/"} and meta["source"] == "u r l" and meta["mapping_provider"] == "P" and meta["comment"] == "c d"
    with open(tmp_path / "set.tsv", "ab") as out:
        out.write(b"a\tb\tc\n")
    with pytest.raises(Exception, match="more than 2 cells"):
        T.scan_sssom(spark, str(tmp_path / "set.tsv"))[1].collect()
    with pytest.raises(ValueError):
        T.scan_sssom(spark, str(tmp_path / "parts"))
