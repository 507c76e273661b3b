"""Many small files: found and read by tasks, with the rows that Spark's readers give."""

import gzip

import pytest

from idtrail.sources import files as W, manifest as M, records


def _put(root, name, data):
    (root / name).parent.mkdir(parents=True, exist_ok=True)
    (root / name).write_bytes(data)


def _listed(df):
    """Whether the driver holds the list of files that ``df`` reads."""
    return "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_manifests_are_found_and_read_by_tasks(spark, rows, tmp_path):
    _put(tmp_path, "a b%2B+é/config", b"\xef\xbb\xbfrelease=1\r\ndate=\rurl=x=y\n\nno entry")
    _put(tmp_path, "c/config", b"")
    _put(tmp_path, "d/data/config", b"k=v\n")
    _put(tmp_path, "e.txt", b"k=v\n")
    _put(tmp_path, "f/config", gzip.compress(b"k=v"))  # no ending, no compression
    found = M.scan_manifest(spark, str(tmp_path / "*" / "config"))
    assert not _listed(found)
    assert rows(found.where("datasource <> 'f'")) == [("a b%2B+é", "date", None), ("a b%2B+é", "release", "1"), ("a b%2B+é", "url", "x=y")]
    with pytest.raises(FileNotFoundError):
        M.scan_manifest(spark, str(tmp_path / "*" / "none"))


def test_files_of_sources_are_found_by_tasks(spark, rows, tmp_path):
    for name in ("data/s/data/x y.gz", "data/s/data/folder/below/z", "data/s/data/hidden/_z", "data/s/data/.h", "data/s/other/n"):
        _put(tmp_path, name, b"1")
    _put(tmp_path, "data/s/data/empty", b"")
    found = M.manifest_files(spark, str(tmp_path / "data"))
    assert not _listed(found)
    assert rows(found) == [("s", "folder"), ("s", "x y.gz")]


def test_directory_is_read_by_tasks_as_spark_reads_it(spark, rows, tmp_path):
    one = "<metabolite><accession>{0}</accession><secondary_accessions/><name>ü {0}</name></metabolite>"
    for name in ("a.xml", "b c.xml", "below/e.xml", "_f.xml", ".g.xml"):
        _put(tmp_path, name, one.format(name).encode())
    _put(tmp_path, "z.xml.gz", gzip.compress(one.format("z").encode()))
    _put(tmp_path, "empty.xml", b"")
    _put(tmp_path, records.XML_CONTAINER, b"\xff")
    found = records.scan_xml_directory(spark, str(tmp_path))
    assert not _listed(found)
    assert rows(found, "primaryID", "name") == [(n, f"ü {n}") for n in ("a.xml", "b c.xml", "z")]
    old = spark.read.text(str(tmp_path), wholetext=True).where(f"_metadata.file_name <> '{records.XML_CONTAINER}'")
    assert rows(records.xml_documents(old.select("value")), "primaryID", "name") == rows(found, "primaryID", "name")
    _put(tmp_path, "parts/k=1/d.xml", one.format("d").encode())
    assert rows(records.scan_xml_directory(spark, str(tmp_path / "parts")), "primaryID") == [("d",)]
    for path in ("none", "none/*"):
        with pytest.raises(FileNotFoundError):
            records.scan_xml_directory(spark, str(tmp_path / path))
    # other patterns are Spark's
    assert W.task_path(spark, str(tmp_path / "{a,b c}.xml")) is None
    assert rows(records.scan_xml_directory(spark, str(tmp_path / "{a,b c}.xml")), "primaryID") == [("a.xml",), ("b c.xml",)]


def test_no_task_writes_all_files(spark):
    from idtrail.queries.scanning import _for_files

    dealt = _for_files(spark.range(400).coalesce(1).selectExpr("'n' || id AS name"), "name")
    assert dealt.selectExpr("spark_partition_id() AS p").distinct().count() > 4
