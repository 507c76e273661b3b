"""Paths into nested documents, and builds from a folder of manifests."""

import pytest

from idtrail.plans.manifests import lacking, publish_all
from idtrail.sources.paths import parse_path, xml_columns

DOCUMENT = (
    '<r xmlns="http://q" xmlns:n="http://n" id="7"><n:a k="1">x</n:a><a k="2">y</a><b><c>1</c><c/><c> 2 </c></b><b/><b><c>3</c></b>'
    "<e><![CDATA[<a>]]></e></r>"
)


def test_paths(spark):
    rows = spark.createDataFrame([(1, DOCUMENT), (2, None), (3, "<r/>")], "k int, value string")
    paths = {"id": "@id", "a": "a[]", "ks": "a[]/@k", "one": "a", "k1": "a/@k", "cs": "b[]/c[]", "c1": "b/c[]", "bc": "b[]/c", "e": "e"}
    found = {r["k"]: r for r in xml_columns(rows, paths).collect()}
    told = {c: found[1][c] for c in paths}
    assert told == {
        "id": "7", "a": ["x", "y"], "ks": ["1", "2"], "one": "x", "k1": "1", "cs": ["1", "2", "3"], "c1": ["1", "2"], "bc": ["1", "3"], "e": "<a>",
    }
    for k in (2, 3):
        assert [found[k][c] for c in paths] == [None, [], [], None, None, [], [], [], None]


def test_paths_of_malformed_documents(spark):
    rows = spark.createDataFrame([("<r><a>1</a></r>",), ("<r><a>2</a>",)], "value string")
    assert [r["x"] for r in xml_columns(rows, {"x": "a"}, strict=False).collect()] == ["1"]
    with pytest.raises(Exception, match="malformed document"):
        xml_columns(rows, {"x": "a"}).collect()
    with pytest.raises(ValueError, match="there already"):
        xml_columns(rows, {"Value": "a"})


@pytest.mark.parametrize("path", ["", "/a", "a//b", "a/", "@k/a", "a/@k[]", "a[1]", "a/text()", "1a"])
def test_bad_paths(path):
    with pytest.raises(ValueError, match="no path"):
        parse_path(path)


@pytest.fixture
def root(tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)

    put("hgnc/config", "release=\ndate=2024-01-31\nurl=http://h/\ninputs=withdrawn:w.txt\n")
    put("hgnc/data/w.txt", "x\n")
    put("HMDB/config", "date=2021-11-17\nurl=http://m/\ninputs=directory:docs\n")
    document = "<metabolite><accession>H1</accession><secondary_accessions><accession>H01</accession></secondary_accessions><name>n</name><synonyms/></metabolite>"
    put("HMDB/data/docs/one.xml", document)
    put("other/config", "date=2024\nurl=u\ninputs=a:b\n")
    put("uniprot/config", "inputs=fasta:,secondary:s.txt,deleted:d.txt\n")
    return str(tmp_path)


def test_what_is_absent(spark, root):
    assert sorted(map(tuple, lacking(spark, root).collect())) == [
        ("hgnc", "input", "complete"), ("other", "file", "b"), ("other", "source", "other"),
        ("uniprot", "file", "d.txt"), ("uniprot", "file", "s.txt"), ("uniprot", "key", "date"), ("uniprot", "key", "url"), ("uniprot", "value", "fasta"),
    ]


def test_whole_sources_are_published(spark, root, tmp_path):
    out = str(tmp_path / "out")
    tables = publish_all(spark, root, out)
    assert list(tables) == ["HMDB"]
    assert [(r["primaryID"], r["secondaryID"]) for r in tables["HMDB"]["mappings"].collect()] == [("H1", "H01")]
    assert spark.read.parquet(f"{out}/absent").count() == 8
    assert "http://m/" in "".join(r["value"] for r in spark.read.text(f"{out}/hmdb/sssom_tsv").collect())
