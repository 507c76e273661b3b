"""Each source end to end on small files in its own format."""

import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from idtrail.plans.build import publish, source_tables
from idtrail.plans import profiles as P
from idtrail.sources import lines, manifest, records, tabular, triples

HISTORY = """#tax_id\tGeneID\tDiscontinued_GeneID\tDiscontinued_Symbol\tDiscontinue_Date
9606\t-\t101\tOLD1\t20200101
9606\t7\t102\tOLD2\t-
9606\t8\t103\tOLD3\t20200202
9606\t8\t104\tOLD"4\t20200303
9606\t103\t105\tOLD5\t20190101
9606\t9\t106\tOLD6\t20200404
9606\t10\t106\tOLD6\t20200404
9606\t11\t107\tOLD7\t20200505
9606\t11\t108\tOLD8\t20200505
9606\t12\t107\tOLD7\t20200505
9606\t-\t109\tOLD9\t20200606
9606\t13\t109\tOLD9\t20200606
10090\t7\t102\tOLD2\t-
"""
INFO = """#tax_id\tGeneID\tSymbol\tSymbol_from_nomenclature_authority\tSynonyms
9606\t7\tAAA\tAAA\tA1|BBX
9606\t8\tBBB\tBBX\t-
9606\t9\tCCC\t-\tC1||C2
10090\t7\tAaa\t-\tZ
"""


@pytest.fixture
def ncbi_inputs(tmp_path):
    for name, text in {"history": HISTORY, "info": INFO}.items():
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write(text)
    return {n: str(tmp_path / f"{n}.gz") for n in ("history", "info")}


def test_ncbi(spark, rows, ncbi_inputs):
    t = source_tables(spark, "NCBI", ncbi_inputs, "v1")
    got = rows(t["mappings"], "primaryID", "secondaryID", "mapping_cardinality", "primarySymbol", "secondarySymbol")
    assert got == sorted([
        ("Entry Withdrawn", "101", "1:0", "Entry Withdrawn", "OLD1"),
        ("7", "102", "1:1", "AAA", "OLD2"),
        ("8", "103", "n:1", "BBB|BBX", "OLD3"),
        ("8", "104", "n:1", "BBB|BBX", 'OLD"4'),
        ("103", "105", "1:1", "OLD3", "OLD5"),
        ("9", "106", "1:n", "CCC", "OLD6"),
        ("10", "106", "1:n", None, "OLD6"),
        ("11", "107", "n:n", None, "OLD7"),
        ("11", "108", "n:1", None, "OLD8"),
        ("12", "107", "1:n", None, "OLD7"),
        ("Entry Withdrawn", "109", "1:0", "Entry Withdrawn", "OLD9"),
        ("13", "109", "1:n", None, "OLD9"),
    ], key=lambda r: [(v is None, str(v)) for v in r])
    text = {(r.primaryID, r.secondaryID): (r.predicateID, r.comment) for r in t["mappings"].collect()}
    assert text["Entry Withdrawn", "101"] == ("oboInOwl:consider", "Withdrawn date: 20200101. ID (subject) withdrawn/deprecated. Release: v1.")
    assert text["7", "102"] == ("IAO:0100001", "ID (subject) is replaced. Release: v1.")
    assert text["8", "103"] == ("IAO:0100001", "Withdrawn date: 20200202. This ID (subject) and other ID(s) are merged into one ID. Release: v1.")
    assert text["103", "105"] == ("IAO:0100001", "Withdrawn date: 20190101. ID (subject) is replaced. Object is also withdrawn. Release: v1.")
    assert text["11", "107"] == ("oboInOwl:consider", "Withdrawn date: 20200505. This ID (subject) and other ID(s) are merged/split into multiple ID(s). Release: v1.")
    assert rows(t["pri_ids"]) == [("7", "AAA"), ("8", "BBB|BBX"), ("9", "CCC")]
    unofficial = "Unofficial symbol for the gene Release: v1."
    assert rows(t["labels"], "primaryID", "primarySymbol", "secondarySymbol", "comment") == [
        ("7", "AAA", "A1", unofficial),
        ("7", "AAA", "BBX", "The secondary symbol is the nomenclature symbol Release: v1."),
        ("9", "CCC", "C1", unofficial),
        ("9", "CCC", "C2", unofficial),
    ]
    edges = rows(t["edges"], "primaryID", "target", "kind")
    assert ("7", "102", "id") in edges and ("7", "OLD2", "label") in edges and ("8", "BBB", "label") in edges
    assert not any(e[0] == "Entry Withdrawn" for e in edges)


def test_ncbi_publish(spark, rows, ncbi_inputs, tmp_path):
    out = tmp_path / "out"
    t = publish(spark, "NCBI", ncbi_inputs, str(out), "v1", "20240101", provider="P", set_id="s", date="2024-01-01")
    sssom = rows(t["sssom"], "subject_id", "subject_label", "object_id", "object_label", "comment")
    assert ("7", "AAA", None, "A1", None) in sssom
    assert ("7", "AAA", "102", "OLD2", "ID (subject) is replaced.") in sssom
    text = "".join(p.read_text() for p in sorted((out / "sssom_tsv").glob("part-*"))).split("\n")
    assert text[:5] == [
        "# curie_map:",
        '#   NCBI: "http://www.ncbi.nlm.nih.gov/gene/"',
        '#   IAO: "http://purl.obolibrary.org/obo/IAO_"',
        '#   oboInOwl: "http://www.geneontology.org/formats/oboInOwl#"',
        '# mapping_provider: "P"',
    ]
    assert text[5:11] == [
        '# mapping_set_id: "s"',
        '# license: "https://creativecommons.org/publicdomain/zero/1.0/"',
        '# mapping_date: "2024-01-01"',
        '# comment: "object_label represents an alternative symbol by which the subject_label is also known."',
        "",
        "subject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\tmapping_cardinality\tcomment\tsource",
    ]
    assert len([x for x in text[11:] if x]) == t["sssom"].count()
    nodes = spark.read.parquet(str(out / "graph/nodes"))
    assert nodes.where("id = '103' and kind = 'id'").first()["is_primary"] is True
    assert nodes.where("id = '102' and kind = 'id'").first()["is_primary"] is False
    assert nodes.where("id = '102'").first()["system_code"] == "L"
    links = rows(spark.read.parquet(str(out / "graph/links")), "source_id", "target_id")
    assert ("9", "9") in links and ("9", "106") in links
    info = dict(rows(spark.read.parquet(str(out / "graph/info"))))
    assert info["DATASOURCENAME"] == "NCBI" and info["BUILDDATE"] == "20240101"


def test_hgnc(spark, rows, tmp_path):
    (tmp_path / "withdrawn.txt").write_text(
        "HGNC_ID\tSTATUS\tWITHDRAWN_SYMBOL\tMERGED_INTO_REPORT(S) (i.e HGNC_ID|SYMBOL|STATUS)\n"
        "HGNC:1\tEntry Withdrawn\tW1\t\n"
        "HGNC:2\tMerged/Split\tW2\tHGNC:10|SYMA|Approved\n"
        "HGNC:3\tMerged/Split\tW3\tHGNC:11|SYMB|Approved\n"
        "HGNC:4\tMerged/Split\tW4\tHGNC:11|SYMB|Approved\n"
        "HGNC:5\tMerged/Split\tW5\tHGNC:12|SYMC|Approved, HGNC:1|W1|Entry Withdrawn\n"
    )
    (tmp_path / "complete.txt").write_text(
        "hgnc_id\tsymbol\tname\talias_symbol\tprev_symbol\n"
        "HGNC:10\tSYMA\tx\tA1|A2\t\nHGNC:11\tSYMB\tx\t\t\nHGNC:12\tSYMC\tx\tC1\tW5\n"
    )
    inputs = {n: str(tmp_path / f"{n}.txt") for n in ("withdrawn", "complete")}
    t = source_tables(spark, "HGNC", inputs)
    got = rows(t["mappings"], "secondaryID", "primaryID", "primarySymbol", "mapping_cardinality", "comment")
    split = "ID (subject) is split into multiple."
    merged = "This ID (subject) and other ID(s) are merged into one ID."
    assert got == [
        ("HGNC:1", "Entry Withdrawn", "Entry Withdrawn", "1:0", "ID (subject) withdrawn/deprecated."),
        ("HGNC:2", "HGNC:10", "SYMA", "1:1", "ID (subject) is replaced."),
        ("HGNC:3", "HGNC:11", "SYMB", "n:1", merged),
        ("HGNC:4", "HGNC:11", "SYMB", "n:1", merged),
        ("HGNC:5", "HGNC:1", "W1", "1:n", split + " Object is also withdrawn."),
        ("HGNC:5", "HGNC:12", "SYMC", "1:n", split),
    ]
    assert rows(t["labels"], "primaryID", "primarySymbol", "secondarySymbol") == [
        ("HGNC:10", "SYMA", "A1"), ("HGNC:10", "SYMA", "A2"), ("HGNC:11", "SYMB", None),
        ("HGNC:12", "SYMC", "C1"), ("HGNC:12", "SYMC", "W5"),
    ]
    assert rows(t["pri_ids"]) == [("HGNC:10", "SYMA"), ("HGNC:11", "SYMB"), ("HGNC:12", "SYMC")]
    got = rows(P.mapping_set("HGNC", t), "subject_id", "object_id", "object_label")
    # W5 also stands in the withdrawn closure, so its covered mapping is held back from the join, but kept.
    assert got == sorted([
        ("Entry Withdrawn", "HGNC:1", "W1"), ("HGNC:1", "HGNC:5", "W5"),
        ("HGNC:10", "HGNC:2", "W2"), ("HGNC:11", "HGNC:3", "W3"), ("HGNC:11", "HGNC:4", "W4"),
        ("HGNC:10", None, "A1"), ("HGNC:10", None, "A2"), ("HGNC:11", None, None),
        ("HGNC:12", None, "C1"), ("HGNC:12", None, "W5"), ("HGNC:12", "HGNC:5", "W5"),
    ], key=lambda r: [(v is None, str(v)) for v in r])
    from idtrail.operators.sssom import merge_mappings_labels

    joined = merge_mappings_labels(t["mappings"], t["labels"], held_rows="join")
    row = joined.where("subject_id = 'HGNC:12' and object_label = 'W5'").collect()
    assert len(row) == 1 and row[0]["object_id"] == "HGNC:5"
    assert row[0]["source"].endswith("withdrawn.txt https://www.genenames.org/download/archive/quarterly/tsv/complete.txt")
    dropped = merge_mappings_labels(t["mappings"], t["labels"], held_rows="drop")
    assert dropped.where("object_id = 'HGNC:5' and subject_id = 'HGNC:12'").isEmpty()


def test_uniprot(spark, rows, tmp_path):
    (tmp_path / "x.fasta").write_text(">sp|P00001|ONE_HUMAN text\nMKV\n>sp|P00002|TWO_HUMAN text\nMM|A|\n")
    (tmp_path / "sec.txt").write_text("".join(f"line {i}\n" for i in range(31)) + "Q1     P1\nQ2  P2\nQ3  P2\n\nQ4 P3\nQ4 P4\n")
    footer = "\n----\nCopyrighted\nby\n----\n"
    (tmp_path / "del.txt").write_text("".join(f"line {i}\n" for i in range(27)) + "D1\nD2\n" + footer)
    inputs = {"fasta": str(tmp_path / "x.fasta"), "secondary": str(tmp_path / "sec.txt"), "deleted": str(tmp_path / "del.txt")}
    t = publish(spark, "UniProt", inputs, str(tmp_path / "out"), "v2")
    assert rows(t["pri_ids"]) == [("P00001",), ("P00002",)]
    assert rows(t["mappings"], "primaryID", "secondaryID", "mapping_cardinality", "comment") == [
        ("Entry Withdrawn", "D1", "1:0", "ID (subject) withdrawn/deprecated. Release: v2."),
        ("Entry Withdrawn", "D2", "1:0", "ID (subject) withdrawn/deprecated. Release: v2."),
        ("P1", "Q1", "1:1", "ID (subject) is replaced. Release: v2."),
        ("P2", "Q2", "n:1", "This ID (subject) and other ID(s) are merged into one ID. Release: v2."),
        ("P2", "Q3", "n:1", "This ID (subject) and other ID(s) are merged into one ID. Release: v2."),
        ("P3", "Q4", "1:n", "ID (subject) is split into multiple. Release: v2."),
        ("P4", "Q4", "1:n", "ID (subject) is split into multiple. Release: v2."),
    ]
    assert t["sssom"].columns == ["subject_id", "predicate_id", "object_id", "mapping_cardinality", "comment", "source"]


def test_line_lists_across_splits(spark, rows, tmp_path):
    """Heads and tails are cut per file, however small the splits are."""
    for f in "ab":
        body = "".join(f"{f}{i} {f}T{i}\n" for i in range(500))
        (tmp_path / f"{f}.txt").write_text("preamble line\n" * 31 + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        scanned = lines.scan_lines(spark, str(tmp_path))
        assert scanned.select("block").distinct().count() > 5
        got = lines.secondary_accessions(lines.trim_lines(scanned, 31, 4))
        assert rows(got) == sorted((f"{f}{i}", f"{f}T{i}") for f in "ab" for i in range(496))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


SDF = """> <ChEBI ID>
CHEBI:1

> <ChEBI Name>
water

> <Secondary ChEBI ID>
CHEBI:91
CHEBI:92

> <Synonyms>
aqua
H2O

$$$$
> <ChEBI ID>
CHEBI:2

> <ChEBI Name>
lonely

$$$$
"""


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_sdf(spark, rows, tmp_path, line_end):
    (tmp_path / "x.sdf").write_bytes(SDF.replace("\n", line_end).encode())
    t = P.chebi(records.scan_sdf(spark, str(tmp_path / "x.sdf")))
    assert rows(t["pri_ids"]) == [("CHEBI:1",), ("CHEBI:2",)]
    assert rows(t["mappings"]) == [("CHEBI:1", "CHEBI:91"), ("CHEBI:1", "CHEBI:92")]
    assert rows(t["labels"]) == [("CHEBI:1", "water", "H2O"), ("CHEBI:1", "water", "aqua")]
    assert rows(t["attributes"], "id", "attr_value") == [
        ("CHEBI:1", "H2O"), ("CHEBI:1", "aqua"), ("CHEBI:1", "water"), ("CHEBI:2", "lonely")]


def test_chebi_publish(spark, rows, tmp_path):
    (tmp_path / "x.sdf").write_text(SDF)
    t = publish(spark, "ChEBI", {"sdf": str(tmp_path / "x.sdf")}, str(tmp_path / "out"), "223", "20240101")
    assert rows(t["sssom"], "subject_id", "subject_label", "object_id", "object_label", "mapping_cardinality") == [
        ("CHEBI:1", "water", "CHEBI:91", "H2O", "n:1"),
        ("CHEBI:1", "water", "CHEBI:91", "aqua", "n:1"),
        ("CHEBI:1", "water", "CHEBI:92", "H2O", "n:1"),
        ("CHEBI:1", "water", "CHEBI:92", "aqua", "n:1"),
    ]


def test_sdf_across_splits(spark, tmp_path):
    text = "".join(f"mol\n> <ChEBI ID>\nCHEBI:{i}\n\n> <Synonyms>\ns{i}\nt{i}\n\n$$$$\n" for i in range(3000))
    (tmp_path / "x.sdf").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = records.scan_sdf(spark, str(tmp_path / "x.sdf"))
        assert df.rdd.getNumPartitions() > 5
        assert df.where("size(synonyms) = 2").select("primaryID").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _metabolite(i, secondary, synonyms):
    def part(tag, child, values):
        if values is None:
            return ""
        inner = "".join(f"<{child}>{v}</{child}>" for v in values)
        return f"<{tag}>{inner}</{tag}>" if inner else f"<{tag}/>"

    return (f"<metabolite><accession>H{i}</accession>{part('secondary_accessions', 'accession', secondary)}"
            f"<name>n{i}</name>{part('synonyms', 'synonym', synonyms)}</metabolite>")


METABOLITES = {1: (["H8", "H9"], ["a"]), 2: ([], ["b", " "]), 3: (["H3"], []), 4: (None, ["d"]), 5: (["H7"], None)}


@pytest.mark.parametrize("kind", ["xml", "directory", "archive"])
def test_hmdb(spark, rows, tmp_path, kind):
    docs = {i: _metabolite(i, *v) for i, v in METABOLITES.items()}
    if kind == "xml":
        path = tmp_path / "all.xml"
        path.write_text('<?xml version="1.0"?>\n<hmdb>\n' + "\n".join(docs.values()) + "\n</hmdb>\n")
    elif kind == "directory":
        path = tmp_path / "docs"
        path.mkdir()
        for i, d in docs.items():
            (path / f"{i}.xml").write_text(d)
        (path / "hmdb_metabolites.xml").write_text(docs[1])
    else:
        path = tmp_path / "docs.zip"
        with zipfile.ZipFile(path, "w") as z:
            for i, d in docs.items():
                z.writestr(f"hmdb/{i}.xml", d)
            z.writestr("hmdb/hmdb_metabolites.xml", docs[1])
    t = publish(spark, "HMDB", {kind: str(path)}, str(tmp_path / "out"), "5", "20240101")
    assert rows(t["pri_ids"]) == [("H1",), ("H2",), ("H3",), ("H5",)]
    assert rows(t["mappings"]) == [("H1", "H8"), ("H1", "H9"), ("H3", "H3"), ("H5", "H7")]
    assert rows(t["labels"]) == [("H1", "n1", "a"), ("H2", "n2", "b"), ("H3", "n3", None), ("H5", "n5", None)]
    assert rows(t["sssom"], "subject_id", "object_id", "mapping_cardinality") == [
        ("H1", "H8", "n:1"), ("H1", "H9", "n:1"), ("H2", None, None), ("H3", None, None), ("H5", "H7", "1:1")]


def test_wikidata_result(spark, rows, tmp_path):
    iri = "<http://www.wikidata.org/entity/"
    (tmp_path / "r.tsv").write_text(
        "?primaryID\t?secondaryID\t?name\t?synonym\n"
        f'{iri}Q1>\t{iri}Q91>\t"water"@en\t"aqua"@en\n{iri}Q1>\t{iri}Q92>\t"water"@en\t"aqua"@en\n{iri}Q2>\t\t\t\n')
    t = publish(spark, "Wikidata", {"result": str(tmp_path / "r.tsv"), "kind": "chemical"}, str(tmp_path / "out"))
    assert rows(t["redirects"]) == [("Q1", "Q91", "water", "aqua"), ("Q1", "Q92", "water", "aqua"), ("Q2", None, None, None)]
    # two secondaries and one label pair give two rows, not four
    assert rows(t["sssom"], "subject_id", "object_id", "object_label", "mapping_cardinality") == [
        ("Q1", "Q91", "aqua", "n:1"), ("Q1", "Q92", "aqua", "n:1"), ("Q2", None, None, None)]
    (tmp_path / "bad.tsv").write_text("x\njava.util.concurrent.TimeoutException\n")
    with pytest.raises(ValueError):
        source_tables(spark, "Wikidata", {"result": str(tmp_path / "bad.tsv"), "kind": "chemical"})


def test_wikidata_triples(spark, rows, tmp_path):
    data = [
        ("Q1", "wdt:P31", "Q7187", None), ("Q1", "wdt:P703", "Q15978631", None),
        ("Q91", "owl:sameAs", "Q1", None), ("Q92", "owl:sameAs", "Q1", None),
        ("Q1", "rdfs:label", "GENE1", "en"), ("Q1", "rdfs:label", "GEN1", "fr"), ("Q1", "skos:altLabel", "G1", "en"),
        ("Q2", "p:P31", "s2", None), ("s2", "ps:P31", "Q7187", None), ("Q2", "wdt:P703", "Q15978631", None),
        ("Q3", "wdt:P31", "Q7187", None),
    ]
    path = str(tmp_path / "triples")
    triples.write_triples(spark.createDataFrame(data, "subject string, predicate string, object string, lang string"), path)
    t = source_tables(spark, "Wikidata", {"triples": path, "kind": "gene"})
    assert rows(t["redirects"]) == [("Q1", "Q91", "GENE1", "G1"), ("Q1", "Q92", "GENE1", "G1"), ("Q2", None, None, None)]


def test_manifest(spark, rows, tmp_path):
    (tmp_path / "chebi").mkdir()
    (tmp_path / "chebi" / "config").write_text("release=223\ndate=\nurl=http://x/?a=b\nfile_names=a.tsv,b.tsv\n\n")
    m = manifest.scan_manifest(spark, str(tmp_path / "*" / "config"))
    assert rows(m) == [("chebi", "date", None), ("chebi", "file_names", "a.tsv,b.tsv"), ("chebi", "release", "223"), ("chebi", "url", "http://x/?a=b")]
    assert rows(manifest.manifest_list(m, "file_names")) == [("chebi", "a.tsv"), ("chebi", "b.tsv")]
    df = manifest.with_metadata(spark.createDataFrame([("chebi",), ("hmdb",)], "datasource string"), m, "release", "release")
    assert rows(df) == [("chebi", "223"), ("hmdb", None)]


def test_short_rows(spark, rows, tmp_path):
    (tmp_path / "x.tsv").write_text('a\tb\tc\n1\tx"y\t\n2\n\n3\tp\tq\n')
    got = tabular.scan_processed(spark, str(tmp_path / "x.tsv"), ["a", "b", "c"])
    assert rows(got) == [("1", 'x"y', None), ("2", None, None), ("3", "p", "q")]
    assert got.where(F.col("a") == "3").count() == 1


def test_command_line(spark, tmp_path):
    from idtrail.__main__ import main

    (tmp_path / "x.sdf").write_text(SDF)
    main(["ChEBI", f"sdf={tmp_path / 'x.sdf'}", "--out", str(tmp_path / "out"), "--release", "223", "--date", "2024-01-01",
          "--meta", "provider=me", "--tsv", "--rename", "secondaryID=old"])
    folder = tmp_path / "out" / "chebi"
    text = "".join(p.read_text() for p in sorted((folder / "mappings_tsv").glob("part-*")))
    assert text.split("\n")[0] == "primaryID\told" and sorted(text.split("\n")[1:3]) == ["CHEBI:1\tCHEBI:91", "CHEBI:1\tCHEBI:92"]
    assert tabular.scan_export(spark, str(folder / "pri_ids_tsv"), ["primaryID"]).count() == 2
    assert '# mapping_date: "2024-01-01"' in "".join(p.read_text() for p in (folder / "sssom_tsv").glob("part-*"))
    info = {r["key"]: r["value"] for r in spark.read.parquet(str(folder / "graph/info")).collect()}
    assert info == {"BUILDDATE": "20240101", "DATASOURCENAME": "ChEBI", "DATASOURCEVERSION": "223", "DATATYPE": "Identifiers"}
