"""Shuffles of the most used plans, and what a build does besides its tables."""

import gzip
import os
import re
import zipfile

import pytest

from idtrail.plans.build import publish
from idtrail.queries import QUERIES
from idtrail.session import work_folder
from idtrail.sources import records, tabular
from tests.oracle import DATA

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture
def no_broadcasts(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is before it runs
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name, most", [("described_mappings", 6), ("redirects_by_class", 16), ("skip_head_tail", 0), ("cardinality_edges", 6), ("xref_sets", 2)])
def test_shuffles(spark, no_broadcasts, name, most):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if re.search(r"[ -]Exchange (hash|Round|Single|range)", x) and "ReusedExchange" not in x]
    assert len(shuffles) <= most, (len(shuffles), shuffles)
    assert "BroadcastExchange" not in plan


def test_crlf_through_publish(spark, rows, tmp_path):
    block = "\r\n  x\r\nM  END\r\n> <ChEBI ID>\r\nCHEBI:{0}\r\n\r\n> <Secondary ChEBI ID>\r\nCHEBI:9{0}\r\n\r\n> <ChEBI Name>\r\na $$$$ b\r\n\r\n$$$$\r\n"
    (tmp_path / "x.sdf").write_bytes("".join(block.format(i) for i in range(5)).encode())
    t = publish(spark, "ChEBI", {"sdf": str(tmp_path / "x.sdf")}, str(tmp_path / "out"))
    assert rows(t["mappings"]) == [(f"CHEBI:{i}", f"CHEBI:9{i}") for i in range(5)]


def test_na_is_a_symbol_through_publish(spark, rows, tmp_path):
    with gzip.open(tmp_path / "h.gz", "wt") as f:
        f.write("#tax_id\tGeneID\tDiscontinued_GeneID\tDiscontinued_Symbol\tDiscontinue_Date\n9606\t1\t5\tOLD\t-\n")
    with gzip.open(tmp_path / "i.gz", "wt") as f:
        f.write("#tax_id\tGeneID\tSymbol\tSymbol_from_nomenclature_authority\tSynonyms\n9606\t1\tS1\tNA\tNA|x\n9606\t2\tS2\t-\t-\n")
    manifests = tmp_path / "sources" / "ncbi"
    manifests.mkdir(parents=True)
    (manifests / "config").write_text("url=the archive\n")
    out = tmp_path / "out"
    t = publish(spark, "NCBI", {"history": str(tmp_path / "h.gz"), "info": str(tmp_path / "i.gz")}, str(out), manifest=str(tmp_path / "sources" / "*" / "config"))
    assert rows(t["labels"], "primarySymbol", "secondarySymbol") == [("S1|NA", "NA"), ("S1|NA", "x")]
    text = "".join((out / "sssom_tsv" / f).read_text() for f in sorted(os.listdir(out / "sssom_tsv")) if f.startswith("part"))
    assert '# mapping_provider: "the archive"' in text
    assert t["quality"].where("check = 'mapping rows'").first()["n"] == 1
    assert os.path.isdir(out / "quality")


def test_a_build_removes_its_folders(spark, tmp_path, monkeypatch):
    from idtrail.plans import build

    used = []
    monkeypatch.setattr(build, "work_folder", lambda s: used.append(str(tmp_path / "work")) or used[-1])
    (tmp_path / "x.sdf").write_text("\n> <ChEBI ID>\nCHEBI:1\n\n$$$$\n")
    t = publish(spark, "ChEBI", {"sdf": str(tmp_path / "x.sdf")}, str(tmp_path / "out"))
    assert len(used) == 1 and not os.path.exists(used[0]) and t["pri_ids"].count() == 1


def test_marked_result_files_are_left_out(spark, rows, tmp_path):
    iri = "<http://www.wikidata.org/entity/"
    head = "?primaryID\t?secondaryID\t?name\t?synonym\n"
    good = head + f'{iri}Q1>\t{iri}Q2>\t"a"@en\t"b"@en\n'
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.tsv").write_text(good)
    from idtrail.functions.vocab import FAILED_EXTRACT

    (tmp_path / "r" / "b.tsv").write_text(good.replace("Q1", "Q7") + f"{FAILED_EXTRACT}\n")
    t = publish(spark, "Wikidata", {"result": str(tmp_path / "r"), "kind": "chemical"}, str(tmp_path / "out"))
    assert rows(t["mappings"]) == [("Q1", "Q2")]


def test_malformed_xml(spark, rows, tmp_path):
    one = "<metabolite><accession>{0}</accession><secondary_accessions/><name>{1}</name></metabolite>\n"
    (tmp_path / "x.xml").write_text("<all>" + one.format("H1", "a") + one.format("H2", "a & b") + "</all>")
    with pytest.raises(Exception, match="malformed document"):
        records.scan_xml(spark, str(tmp_path / "x.xml")).collect()
    assert rows(records.scan_xml(spark, str(tmp_path / "x.xml"), strict=False), "primaryID") == [("H1",)]
    text = spark.createDataFrame([(one.format("H2", "a & b"),), (one.format("H1", "a"),)], "value string")
    assert [r.malformed for r in records.xml_rejects(text).collect()] == [one.format("H2", "a & b")]


def test_container_of_an_archive_is_not_read(spark, rows, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(7):
            z.writestr(f"d/H{i}.xml", f"<metabolite><accession>H{i}</accession><secondary_accessions/></metabolite>")
        z.writestr(f"d/{records.XML_CONTAINER}", b"\xff\xfe not text")
    got = records.scan_xml_archives(spark, str(tmp_path / "a.zip"))
    assert rows(got, "primaryID") == [(f"H{i}",) for i in range(7)]
    files = spark.createDataFrame([(f"file:{tmp_path}/a.zip",)], "path string")
    assert records.zip_documents(files, chunk_bytes=100).count() == 7


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.tsv").write_text("x\ty\n1\t2\n")
    (tmp_path / "t" / "b.tsv").write_text("y\tx\n2\t1\n")
    with pytest.raises(Exception):
        tabular.scan_tsv(spark, str(tmp_path / "t"), ("x", "y")).collect()


def test_only_a_local_session_may_lack_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(ValueError):
        work_folder(Session())
    Session.sparkContext.master = "local[4]"
    assert work_folder(Session())
