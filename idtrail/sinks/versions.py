"""Rebuilds as commits: a build is written beside the one in use and becomes it by one small file.

``root/data/<name>`` holds the tables of one build, ``root/commits/<number>`` the name of a build that is complete. A commit file is
created only if there is none of its number, so of two builds that end together one takes the next number. Readers take the folder
of the highest number once and keep to it; older builds stay until :func:`expire`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from idtrail.session import remove_folder


class Version(NamedTuple):
    number: int
    folder: str


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and when they were last changed (milliseconds); empty if there is no such folder."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(place)}


def _content(spark: SparkSession, path: str) -> str:
    files, place = _files(spark, path)
    with_lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(place), "UTF-8"))
    try:
        return with_lines.readLine() or ""
    finally:
        with_lines.close()


def versions(spark: SparkSession, root: str) -> list[Version]:
    """Complete builds, oldest first. A commit file that its writer is still filling does not count yet."""
    root = root.rstrip("/")
    numbers = sorted(int(n) for n in _names(spark, f"{root}/commits") if n.isdigit())
    named = [(n, _content(spark, f"{root}/commits/{n:010d}")) for n in numbers]
    return [Version(n, f"{root}/data/{name}") for n, name in named if name]


def current(spark: SparkSession, root: str) -> Version:
    """The newest complete build. Whoever reads several tables asks once, and reads all of them from its folder."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no complete build in {root}")
    return found[-1]


def read_version(spark: SparkSession, root: str, name: str, version: Version | None = None) -> DataFrame:
    """Table ``name`` of ``version``, by default of the newest build at the time of the call, whatever is committed later."""
    return spark.read.parquet(f"{(version or current(spark, root)).folder}/{name}")


@contextmanager
def building(spark: SparkSession, root: str, keep: int = 2) -> Iterator[str]:
    """The folder for a new build, which is committed when the block ends; if the block fails, the folder goes and nothing changes.

    Afterwards only the ``keep`` newest builds stay.
    """
    name = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/data/{name}"
    try:
        yield folder
        commit(spark, root, name)
    except BaseException:
        remove_folder(spark, folder)
        raise
    expire(spark, root, keep)


def commit(spark: SparkSession, root: str, name: str) -> int:
    """Makes ``root/data/<name>`` the newest build and returns its number."""
    root = root.rstrip("/")
    number = max((int(n) for n in _names(spark, f"{root}/commits") if n.isdigit()), default=0)
    while True:
        number += 1
        files, place = _files(spark, f"{root}/commits/{number:010d}")
        try:
            out = files.create(place, False)
        except Exception:
            if files.exists(place):
                continue  # another build took the number
            raise
        try:
            out.write(bytearray(name, "ascii"))
        finally:
            out.close()
        return number


def expire(spark: SparkSession, root: str, keep: int = 2, orphan_hours: float | None = None) -> list[int]:
    """Removes all builds but the ``keep`` newest (at least one) and returns their numbers.

    With ``orphan_hours``, also folders that no commit names and that have not changed for so long: jobs that were killed.
    """
    root = root.rstrip("/")
    found = versions(spark, root)
    old = found[: -max(1, keep)]
    for version in old:  # the name first, so that no reader begins on a folder that goes
        files, place = _files(spark, f"{root}/commits/{version.number:010d}")
        files.delete(place, False)
        remove_folder(spark, version.folder)
    if orphan_hours is not None:
        now = spark._jvm.java.lang.System.currentTimeMillis()
        known = {v.folder.rsplit("/", 1)[-1] for v in found}
        for name, changed in _names(spark, f"{root}/data").items():
            if name not in known and now - changed >= orphan_hours * 3_600_000:
                remove_folder(spark, f"{root}/data/{name}")
    return [v.number for v in old]


def write_version(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], keep: int = 2) -> Version:
    """All ``tables`` as one build: readers see all of them or the build before."""
    with building(spark, root, keep) as folder:
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
    return next(v for v in versions(spark, root) if v.folder == folder)
