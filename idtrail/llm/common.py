"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idtrail.session import staged

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns ``doc_id`` (long) and ``text`` (null: empty), whatever else ``docs`` carries."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """``make`` turns each Arrow batch into columns of ``schema``; batches come one after the other."""
    arrow = None

    def run(batches: Batches) -> Batches:
        nonlocal arrow
        arrow = arrow or arrow_schema(schema)
        for batch in batches:
            yield pa.RecordBatch.from_pydict(make(batch), schema=arrow)

    return df.mapInArrow(run, schema)


TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a flat ``name type, name type`` schema of the types above."""
    return pa.schema([(part.split()[0], TYPES[part.split()[1]]) for part in ddl.split(",")])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``, longs: the smallest node that it is linked to.

    Large-star and small-star rounds: every node hangs its neighbours on the smallest one it knows, until nothing moves.
    Rounds grow with the logarithm of a chain's length. Each ends as a table on shared storage, so a lost executor costs
    one round at most; only a count and a checksum reach the driver.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if mark == before:
            return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            )
        before = mark
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = staged(large.where("v <> u"))
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(
            F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct(F.col("v"), F.col("m").alias("u"))
        )).alias("e")).select("e.*")
        now = staged(small.where("v <> u").distinct())
