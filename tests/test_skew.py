"""Results and task sizes when one key, or one group of copies, holds a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from idtrail.operators import cardinality as K, joins as J, xref as X

N = 30_000


@pytest.fixture
def plain_joins(spark):
    """No broadcasts, and thresholds at which this test's data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_edges(spark):
    """A third of the rows go to one target, a third come from one old id."""
    i = F.col("id")
    return spark.range(N).select(
        F.when(i < N / 3, "HOT").otherwise(F.concat(F.lit("p"), i)).alias("primaryID"),
        F.when(i > N * 2 / 3, "OLD").otherwise(F.concat(F.lit("s"), i)).alias("secondaryID"),
    )


def test_hot_keys_are_classified(spark, plain_joins):
    df = hot_edges(spark)
    counts = {r[0]: r[1] for r in K.with_cardinality(df).groupBy(K.CLASS).count().collect()}
    fan_out = df.where("secondaryID = 'OLD'").count()
    assert counts == {"n:1": N // 3, "1:n": fan_out, "1:1": N - N // 3 - fan_out}
    flagged = K.flag_retired_target(df.union(spark.createDataFrame([("OLD", "HOT")], df.schema)))
    counts = {r[0]: r[1] for r in flagged.where("target_retired").groupBy("primaryID").count().collect()}
    assert counts == {"HOT": N // 3, "OLD": 1}


def split_joins(df):
    """Runs ``df``; how many of its joins Spark split."""
    df.collect()
    return len(re.findall(r"Join\(skew=true\)", df._jdf.queryExecution().executedPlan().toString()))


def test_hot_rows_are_spread(spark, plain_joins):
    """Lookups of counts and members, left joins: the hot partition of the rows is split."""
    rows = hot_edges(spark).withColumn("pad", F.sha2(F.col("secondaryID"), 256))
    assert split_joins(J.with_group_count(rows, "primaryID", "n")) == 1
    assert split_joins(J.flag_member(rows, rows.select("primaryID"), "primaryID", "m")) == 1
    assert split_joins(J.semi_join(rows, rows, ["primaryID"])) == 1
    out = J.with_group_count(rows, "primaryID", "n")
    assert out.where(f"primaryID = 'HOT' and n = {N // 3}").count() == N // 3 and out.count() == N


def test_withdrawn_rows_enter_no_join_by_target(spark, plain_joins):
    """Their one target would be a hot key; they are filtered off below every join by it."""
    from idtrail.operators import sssom as S

    edges = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, "Entry Withdrawn").otherwise(F.concat(F.lit("p"), "id")).alias("primaryID"), F.lit("S").alias("primarySymbol"),
        F.concat(F.lit("s"), "id").alias("secondaryID"), F.concat(F.lit("S"), "id").alias("secondarySymbol"), F.lit("p").alias("predicateID"),
        F.lit("c").alias("mapping_cardinality"), F.lit("c").alias("comment"), F.lit("s").alias("source"),
    )
    labels = edges.where("primaryID != 'Entry Withdrawn'").drop("secondaryID")
    seen = []

    def stage(df):
        seen.append(df.where("primaryID = 'Entry Withdrawn'").count())
        return df

    assert S.merge_mappings_labels(edges, labels, stage=stage).where("subject_id = 'Entry Withdrawn'").count() == 34
    assert seen == [0]
    out = S.sssom_of_two_key_labels(edges, labels)
    assert out.where("subject_id = 'Entry Withdrawn'").count() == 34
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):]
    assert "NOT" in joined or "<=> Entry Withdrawn" in joined


def test_many_null_keys(spark, rows):
    df = spark.createDataFrame([(None, i) for i in range(4)] + [("a", 9)], "k string, v int")
    other = spark.createDataFrame([(None,), ("b",)], "k string")
    assert rows(J.semi_join(df, other, ["k"], null_safe=True), "v") == [(0,), (1,), (2,), (3,)]
    assert rows(J.anti_join(df, other, ["k"], null_safe=True), "v") == [(9,)]
    assert J.anti_join(df, other, ["k"]).count() == 5
    assert rows(K.with_group_size(df, "k", "n"), "n") == [(1,), (4,), (4,), (4,), (4,)]


def test_copies_keep_their_number(spark, plain_joins):
    copies = spark.range(N).select(F.when(F.col("id") < N / 3, "a").otherwise(F.concat(F.lit("p"), "id")).alias("primaryID"))
    copies = copies.withColumn("secondaryID", F.concat(F.lit("s"), "primaryID"))
    out = K.describe_mappings(copies)
    assert out.count() == N
    assert out.where("primaryID = 'a'").select(K.CLASS).distinct().collect()[0][0] == "n:n"


def test_full_join_splits_hot_keys(spark, plain_joins):
    left = spark.range(N).select(F.when(F.col("id") < N / 3, "HOT").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.col("id").alias("a"), F.repeat(F.lit("x"), 50).alias("pad"))
    right = spark.range(N).select(F.when(F.col("id") < 3, "HOT").otherwise(F.concat(F.lit("k"), F.col("id") + 5000)).alias("k"), F.col("id").alias("b"))
    want = left.join(right, "k", "full")
    out = J.full_join(left, right, ["k"])
    assert out.count() == want.count()
    assert out.select("k", "a", "b").exceptAll(want.select("k", "a", "b")).isEmpty()
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join\(skew=true\)", plan), plan[:3000]


@pytest.mark.parametrize("broadcast", [True, False])
def test_null_keys(spark, rows, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        left = spark.createDataFrame([("1", None, "a"), ("1", "x", "b"), (None, None, "c"), ("3", "z", "d")], "k string, l string, a string")
        right = spark.createDataFrame([("1", None, "A"), (None, None, "C"), ("2", "y", "B"), ("1", None, "E")], "k string, l string, b string")
        assert rows(J.full_join(left, right, ["k", "l"]), "k", "l", "a", "b") == sorted([
            ("1", None, "a", "A"), ("1", None, "a", "E"), ("1", "x", "b", None), (None, None, "c", "C"),
            ("2", "y", None, "B"), ("3", "z", "d", None)], key=lambda t: [(v is None, str(v)) for v in t])
        assert rows(J.anti_join(left, right, ["l"], null_safe=True), "a") == [("b",), ("d",)]
        assert rows(J.anti_join(left, right, ["l"]), "a") == [("a",), ("b",), ("c",), ("d",)]
        assert rows(J.semi_join(left, right, ["l"], null_safe=True), "a") == [("a",), ("c",)]
        assert rows(J.flag_member(left, right.select("l"), "l", "m"), "a", "m") == [("a", False), ("b", False), ("c", False), ("d", False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_sets_are_paged(spark):
    edges = hot_edges(spark).select("primaryID", F.col("secondaryID").alias("target"), F.lit("id").alias("kind"))
    hot = X.xref_sets(edges, pages=10).where("primaryID = 'HOT'").select("page", F.size("targets").alias("n")).collect()
    assert len(hot) == 10 and sum(r["n"] for r in hot) == N // 3 and max(r["n"] for r in hot) < 1300
    assert X.xref_sets(edges).where("page != 0").isEmpty()


@pytest.mark.parametrize("head, tail, limit", [(0, 0, 1000), (3, 2, 1000), (31, 0, 7), (0, 25, 4), (40, 70, 9), (1200, 5, 1000)])
def test_trim_rows_in_steps(spark, rows, head, tail, limit):
    """Cuts beyond the number of ranks that Spark limits per partition are found in steps, with the same result."""
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("at")).union(spark.createDataFrame([(7, 1), (7, 2)], "g long, at long"))
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(limit))
    try:
        from idtrail.operators.rows import trim_rows

        got = sorted(tuple(r) for r in trim_rows(df, "g", ["at"], head, tail, F.col("at") % 5 != 0).collect())
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    want = []
    for g, own in ((0, range(0, 3000, 2)), (1, range(1, 3000, 2)), (7, [1, 2])):
        kept = [x for x in list(own)[head:] if x % 5]
        want += [(g, x) for x in kept[: len(kept) - tail if tail else None]] if len(kept) > tail else []
    assert got == sorted(want)


def test_group_size_counts_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    assert rows(K.with_group_size(df, "k", "n"), "v", "n") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 1)]
