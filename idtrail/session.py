"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, bring your own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("idtrail")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # hash join instead of sort-merge join where all measured partitions are small enough
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """A new, empty folder name on shared storage.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without that setting,
    because there a folder of this machine is one that every task can see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="idtrail-")
    return f"{root.rstrip('/')}/idtrail-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, *paths: str) -> None:
    """Deletes folders on whatever storage they are."""
    for place in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs within go when it has ended; otherwise they stay until the driver happens to collect garbage."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def staged(df: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to shared storage (``path``, or a new folder) and read back.

    For inputs that many branches read but that cannot be split or pruned (gzip text, XML):
    they are parsed once, lineage is cut, and a lost executor re-reads a file. What was shuffled on the way leaves
    the disks when the table is there.
    """
    path = path or work_folder(df.sparkSession)
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
