"""Many small files, found and read by tasks: the driver knows the folder that holds them, never a list of them."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMES = ("file:", "hdfs:")
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20


def task_path(spark: SparkSession, path) -> str | None:
    """``path`` with its scheme if tasks can list it themselves, else None: then it is left to Spark's readers, whose list of files is
    in the driver. Names, ``*`` and ``?`` are understood, other patterns and several paths are not."""
    if not isinstance(path, str) or set(path) & set("[]{}\\"):
        return None
    full, _ = _on_driver(spark, path)
    return full if full.startswith(SCHEMES) else None


def _on_driver(spark: SparkSession, path: str) -> tuple[str, bool]:
    """The qualified path, and whether the folder that it begins with is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    system = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    full = system.makeQualified(folder(path)).toString()
    return full, system.exists(folder(_fixed(full)[0]))


def _fixed(path: str) -> tuple[str, list[str]]:
    """The part before the first pattern, and the names from there on."""
    names = path.split("/")
    first = next((i for i, name in enumerate(names) if set(name) & set("*?")), len(names))
    return "/".join(names[:first]), names[first:]


def system_of(path: str):
    """File system and inner path, in a task."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    scheme, _, rest = path.partition("://")
    host, _, inner = rest.partition("/")
    return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0], f"/{inner}"


def _children(path: str) -> Iterator[tuple[str, bool]]:
    """(name, whether it is a folder) in a folder; nothing if it is none."""
    system, inner = system_of(path)
    if system.type_name == "local":
        if os.path.isdir(inner):
            with os.scandir(inner) as found:
                for entry in found:
                    yield entry.name, entry.is_dir()
        return
    from pyarrow import fs

    if system.get_file_info(inner).type == fs.FileType.Directory:
        for entry in system.get_file_info(fs.FileSelector(inner)):
            yield entry.base_name, entry.type == fs.FileType.Directory


def _sizes(paths: Iterable[str]) -> Iterator[tuple[str, int | None]]:
    """(path, bytes) of those that are there; a folder has no bytes."""
    for path in paths:
        system, inner = system_of(path)
        info = system.get_file_info(inner)
        if info.type.name != "NotFound":
            yield path, None if info.type.name == "Directory" else info.size


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _frames(paths: Iterable[str]) -> Iterator[pd.DataFrame]:
    batch = []
    for path in paths:
        batch.append(path)
        if len(batch) == BATCH_ROWS:
            yield pd.DataFrame({"path": batch})
            batch = []
    if batch:
        yield pd.DataFrame({"path": batch})


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[str]:
    for batch in batches:
        yield from batch["path"]


def _spread(paths: DataFrame) -> DataFrame:
    return paths.repartition(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def matches(spark: SparkSession, path: str) -> DataFrame:
    """(path): what ``path``, one of :func:`task_path`, leads to. Names after a pattern are not looked at, so they need not be there.

    Each folder is listed by one task, entry by entry, and what it holds is dealt to all tasks.
    """
    base, names = _fixed(path)
    found = spark.createDataFrame([(base,)], "path string")
    while names:
        after = next((i for i, name in enumerate(names[1:], 1) if set(name) & set("*?")), len(names))
        pattern, below = names[0], "".join(f"/{name}" for name in names[1:after])
        names = names[after:]
        found = _spread(found.mapInPandas(_matching(pattern, below, bool(below or names)), "path string"))
    return found


def _matching(pattern: str, below: str, folders: bool):
    wanted = re.compile(re.escape(pattern).replace(r"\*", ".*").replace(r"\?", "."), re.DOTALL)

    def run(batches):
        return _frames(
            f"{path}/{name}{below}" for path in _paths(batches) for name, is_folder in _children(path)
            if (is_folder or not folders) and wanted.fullmatch(name)
        )

    return run


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path): the files that ``path`` leads to, and those in the folders that it leads to, as Spark's readers take them: without hidden
    ones, and of folders below only partitions (``k=v``). Fails if there are none and ``path`` is a pattern, or it leads nowhere."""
    full, there = _on_driver(spark, path)
    files = _spread(matches(spark, full).mapInPandas(lambda batches: _frames(f for p in _paths(batches) for f in _files_at(p)), "path string"))
    if not there or _fixed(full)[1] and files.isEmpty():
        raise FileNotFoundError(f"nothing at {path}")
    return files


def _files_at(path: str) -> Iterator[str]:
    for _, size in _sizes([path]):
        if size is not None:
            if not _hidden(_name(path)):
                yield path
            return
        for name, is_folder in _children(path):
            if _hidden(name):
                continue
            if not is_folder:
                yield f"{path}/{name}"
            elif "=" in name:
                yield from _files_at(f"{path}/{name}")


def non_empty(paths: DataFrame) -> DataFrame:
    """Of ``paths`` the files that hold something, and the folders with such a file anywhere below; hidden ones don't count."""

    def holds(path: str) -> bool:
        if _hidden(_name(path)):
            return False
        return any(size if size is not None else any(holds(f"{path}/{name}") for name, _ in _children(path)) for _, size in _sizes([path]))

    return paths.mapInPandas(lambda batches: _frames(p for p in _paths(batches) if holds(p)), "path string")


def read_files(spark: SparkSession, path: str, skip: str | None = None) -> DataFrame:
    """(path, content): whole files, decompressed by their ending; empty ones, and those named ``skip``, are left out."""

    def run(batches):
        rows, size = [], 0
        for path in _paths(batches):
            if _name(path) == skip:
                continue
            system, inner = system_of(path)
            with system.open_input_stream(inner) as source:
                content = source.read()
            if content:
                rows.append((path, content))
                size += len(content)
            if size >= BATCH_BYTES or len(rows) == BATCH_ROWS:
                yield pd.DataFrame(rows, columns=["path", "content"])
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["path", "content"])

    return list_files(spark, path).mapInPandas(run, "path string, content binary")
