"""Tables rendered in the native format of a source, written to shared storage and scanned back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C
from idtrail.operators import rows as R
from idtrail.queries import base as B
from idtrail.queries.base import query
from idtrail.session import staged, work_folder
from idtrail.sinks.tables import write_table, write_tsv
from idtrail.sources import lines as N, manifest as M, records as D, tabular as T
from idtrail.sources.nested import record_texts
from idtrail.sources.paths import xml_columns


def _written(df: DataFrame, value) -> str:
    path = work_folder(df.sparkSession)
    df.select(value.alias("value")).write.mode("overwrite").text(path)
    return path


def part_records(spark, folder) -> DataFrame:
    """Parts as nested records; large ones have no secondary ids, small ones no synonyms."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def chebi(n):
        return F.concat(F.lit("CHEBI:"), n)

    return B.table(spark, folder, "part").select(
        chebi(key).alias("primaryID"),
        F.col("p_brand").alias("name"),
        F.when(size > 40, F.array().cast("array<string>")).otherwise(F.array(chebi(key + size), chebi(key + 1000))).alias("secondary"),
        F.when(size < 10, F.array().cast("array<string>")).otherwise(F.split("p_name", " ")).alias("synonyms"),
    )


PART_RECORDS = """records AS (
  SELECT 'CHEBI:' || p_partkey AS "primaryID", p_brand AS name,
    CASE WHEN p_size > 40 THEN [] ELSE ['CHEBI:' || (p_partkey + p_size), 'CHEBI:' || (p_partkey + 1000)] END AS secondary,
    CASE WHEN p_size < 10 THEN [] ELSE string_split(p_name, ' ') END AS synonyms FROM part)"""

FLAT = """SELECT "primaryID", name, array_to_string(secondary, '|') AS secondary, array_to_string(synonyms, '|') AS synonyms FROM records"""


def _flat(records: DataFrame) -> DataFrame:
    return records.withColumns({c: F.array_join(c, "|") for c in ("secondary", "synonyms")})


def _sdf_text():
    def block(tag, values):
        return F.when(F.size(values) > 0, F.concat(F.lit(f"> <{tag}>\n"), F.array_join(values, "\n"), F.lit("\n\n"))).otherwise("")

    return F.concat(
        F.lit("\n  structure\nM  END\n"),
        block(D.ID_TAG, F.array("primaryID")),
        block(D.NAME_TAG, F.array("name")),
        block(D.SECONDARY_TAG, F.col("secondary")),
        block(D.SYNONYM_TAG, F.col("synonyms")),
        F.lit(D.BLOCK_END),
    )


@query(f"WITH {PART_RECORDS} {FLAT}")
def sdf_round_trip(spark, folder):
    return _flat(D.scan_sdf(spark, _written(part_records(spark, folder), _sdf_text())))


@query(f"WITH {PART_RECORDS} {FLAT}")
def sdf_crlf_round_trip(spark, folder):
    """Records with both kinds of line ends in one folder."""
    ends = F.when(F.col("primaryID").endswith("7"), F.lit("\n")).otherwise(F.lit("\r\n"))
    text = F.replace(F.concat(_sdf_text(), F.lit("\n")), F.lit("\n"), ends)
    path = work_folder(spark)
    part_records(spark, folder).select(text.alias("value")).write.option("lineSep", "\u0003").text(path)
    marked = spark.read.option("lineSep", "\u0003").text(path)
    plain = work_folder(spark)
    marked.write.option("lineSep", " ").text(plain)  # the blank ends a record's last, empty line
    return _flat(D.scan_sdf(spark, plain))


def _xml_text():
    def part(tag, child, values):
        inner = F.concat_ws("", F.transform(values, lambda v: F.concat(F.lit(f"<{child}>"), v, F.lit(f"</{child}>"))))
        return F.concat(F.lit(f"<{tag}>"), inner, F.lit(f"</{tag}>"))

    return F.concat(
        F.lit("<metabolite><accession>"), "primaryID", F.lit("</accession>"),
        part("secondary_accessions", "accession", F.col("secondary")),
        F.lit("<name>"), "name", F.lit("</name>"),
        part("synonyms", "synonym", F.col("synonyms")),
        F.lit("</metabolite>"),
    )


@query(f"WITH {PART_RECORDS} {FLAT}")
def xml_round_trip(spark, folder):
    return _flat(D.scan_xml(spark, _written(part_records(spark, folder), _xml_text())))


def _place(folder: str):
    """File system and inner path of a shared folder, for tasks that write files of their own."""
    from pyarrow import fs

    uri = folder if "://" in folder else "file:///" + folder.removeprefix("file:").lstrip("/")
    system, inner = fs.FileSystem.from_uri(uri)
    system.create_dir(inner, recursive=True)
    return system, inner


def _for_files(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to all tasks for writing a file each: few bytes, but each takes the time of a file."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


@query(f"WITH {PART_RECORDS} {FLAT}")
def directory_documents(spark, folder):
    """One file per document in a directory; the container among them holds a record and is skipped by name."""
    path = work_folder(spark)
    documents = part_records(spark, folder).select("primaryID", _xml_text().alias("value"))
    staged(_for_files(documents, "primaryID").mapInPandas(_file_writer(path), "n long"))
    return _flat(D.scan_xml_directory(spark, path))


CONTAINED = "<metabolite><accession>IN-CONTAINER</accession><secondary_accessions/><name>x</name></metabolite>"


def _file_writer(folder: str):
    def run(batches):
        system, inner = _place(folder)
        with system.open_output_stream(f"{inner}/{D.XML_CONTAINER}") as out:
            out.write(CONTAINED.encode())
        for batch in batches:
            for name, text in zip(batch["primaryID"], batch["value"]):
                with system.open_output_stream(f"{inner}/{name.replace(':', '_')}.xml") as out:
                    out.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return run


@query(f"WITH {PART_RECORDS} {FLAT}")
def zip_documents(spark, folder):
    """Documents packed into zip archives, one archive per batch of rows, and scanned entry by entry.

    Each archive has a container, which holds a record that must not appear, and bytes that are no text."""
    path = work_folder(spark)
    documents = part_records(spark, folder).select("primaryID", _xml_text().alias("value"))
    dealt = _for_files(documents, "primaryID").sortWithinPartitions("primaryID")
    staged(dealt.mapInPandas(_archiver(path), "path string"))
    return _flat(D.scan_xml_archives(spark, path))


def _archiver(folder: str):
    def run(batches):
        from pyspark import TaskContext

        system, inner = _place(folder)
        for k, batch in enumerate(batches):
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, text in zip(batch["primaryID"], batch["value"]):
                    archive.writestr(f"docs/{name.replace(':', '_')}.xml", text)
                archive.writestr(f"docs/{D.XML_CONTAINER}", CONTAINED.encode() + b"\xff\xfe")
            # The rows are sorted and the name is the place of the batch: a task that runs again replaces its own archives.
            target = f"{inner}/{TaskContext.get().partitionId()}-{k}.zip"
            with system.open_output_stream(target) as out:
                out.write(packed.getvalue())
            yield pd.DataFrame({"path": [target]})

    return run


@query("""SELECT p_partkey AS id, p_name AS name, p_brand || '</metabolite>' AS brand,
  CASE WHEN p_size % 3 = 0 THEN (p_size + 1) || '|' || (p_size + 2) ELSE '' END AS inner_ids FROM part""")
def xml_records_by_depth(spark, folder):
    """Records with end tags in comments and character data, and with nested elements of the record's own name."""
    part = B.table(spark, folder, "part")

    def element(tag, *values):
        return F.concat(F.lit(f"<{tag}>"), *values, F.lit(f"</{tag}>"))

    size = F.col("p_size")
    inner = [element("metabolite", element("id", size + n)) for n in (1, 2)]
    text = F.concat(
        F.lit("<!-- <metabolite><id>0</id> --><metabolite/>"),
        F.lit("<metabolite a='/>'><!-- </metabolite><metabolite> -->"), element("id", F.col("p_partkey")), element("name", F.col("p_name")),
        element("brand", F.lit("<![CDATA["), F.col("p_brand"), F.lit("</metabolite>]]>")),
        F.when(size % 3 == 0, element("parts", *inner)).otherwise("<parts><metabolite b=\"1\"/></parts>"), F.lit("</metabolite>"),
    )
    found = xml_columns(record_texts(spark, _written(part, text)), {
        "id": "id", "name": "name", "brand": "brand", "inner_ids": "parts/metabolite[]/id",
    })
    return found.select(F.col("id").cast("long").alias("id"), "name", "brand", F.array_join("inner_ids", "|").alias("inner_ids"))


@query("""SELECT p_name AS malformed_name FROM part WHERE p_size > 45""")
def xml_rejects(spark, folder):
    """Documents with a bare ampersand are told apart from the records, whole."""
    part = B.table(spark, folder, "part")
    mark = F.when(F.col("p_size") > 45, " & ").otherwise("")
    text = F.concat(F.lit("<metabolite><accession>"), "p_partkey", F.lit("</accession><secondary_accessions/><name>"), "p_name", mark, F.lit("</name></metabolite>"))
    rejects = D.xml_rejects(part.select(text.alias("value")))
    return rejects.select(F.regexp_extract("malformed", "<name>(.*) & </name>", 1).alias("malformed_name"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS "primaryID" FROM part WHERE p_size <= 45""")
def xml_without_rejects(spark, folder):
    part = B.table(spark, folder, "part")
    mark = F.when(F.col("p_size") > 45, " & ").otherwise("")
    text = F.concat(F.lit("<metabolite><accession>"), "p_partkey", F.lit("</accession><secondary_accessions/><name>"), "p_name", mark, F.lit("</name></metabolite>"))
    return D.xml_documents(part.select(text.alias("value")), strict=False).select("primaryID")


@query("""SELECT c_name AS "primaryID" FROM customer""")
def fasta_ids(spark, folder):
    rows = B.table(spark, folder, "customer")
    header = F.concat(F.lit(">sp|"), "c_name", F.lit("|"), "c_mktsegment", F.lit("_HUMAN text|more"))
    path = _written(rows, F.concat(header, F.lit("\nMKV|LL|\n"), F.upper("c_mktsegment")))
    return N.scan_fasta_ids(spark, path)


def _several(df: DataFrame) -> DataFrame:
    """Rows dealt to three files, or to as many as there are splits to read, so that no task has a fixed share of a large table."""
    return df.repartition(max(3, df.rdd.getNumPartitions()))


def _framed(df: DataFrame, value, head: str, tail: str) -> str:
    """One text file per partition, each with lines before and after its rows."""
    path = work_folder(df.sparkSession)
    staged(_several(df.select(value.alias("value"))).mapInPandas(_frame_writer(path, head, tail), "n long"))
    return path


def _frame_writer(folder: str, head: str, tail: str):
    def run(batches):
        from pyspark import TaskContext

        system, inner = _place(folder)
        n = 0
        with system.open_output_stream(f"{inner}/list-{TaskContext.get().partitionId()}.txt") as out:
            out.write(head.encode())
            for batch in batches:
                n += len(batch)
                out.write("".join(f"{x}\n" for x in batch["value"]).encode())
            out.write(tail.encode())
        yield pd.DataFrame({"n": [n]})

    return run


@query("""SELECT l_orderkey || '-' || l_suppkey AS "secondaryID", l_partkey || '-' || l_suppkey AS "primaryID" FROM lineitem""")
def accession_list(spark, folder):
    """Two-column lists with their preamble and blank lines in between, in several files and splits."""
    line = F.concat("secondaryID", F.lit("      "), "primaryID", F.lit("\n   "))
    head = "".join(f"preamble {i}  x\n" for i in range(N.SECONDARY_PREAMBLE))
    return N.scan_secondary_accessions(spark, _framed(B.live_edges(spark, folder), line, head, ""))


@query("""SELECT 'D' || o_orderkey AS "secondaryID" FROM orders""")
def deleted_accessions(spark, folder):
    """One-column lists with preamble and footer."""
    line = F.concat(F.lit(" D"), "o_orderkey", F.lit(" "))
    head = "\n" + "".join(f"preamble {i}\n" for i in range(N.DELETED_PREAMBLE - 1))
    tail = "\n".join(["", *["---- footer"] * N.DELETED_FOOTER, ""])
    return N.scan_deleted_accessions(spark, _framed(B.table(spark, folder, "orders"), line, head, tail))


def _tsv(df: DataFrame) -> str:
    """Native table text: a header in each of several files, one of them compressed away from the others."""
    path = work_folder(df.sparkSession)
    _several(df).write.options(sep="\t", header=True, quote="", emptyValue="", nullValue="").csv(path)
    return path


@query("""SELECT '9606' AS "#tax_id", 'G' || l_partkey AS "GeneID", 'S' || l_orderkey AS "Discontinued_GeneID", 'a"b' || l_linenumber AS "Discontinued_Symbol",
  strftime(l_shipdate, '%Y%m%d') AS "Discontinue_Date" FROM lineitem""")
def gene_history_scan(spark, folder):
    rows = B.table(spark, folder, "lineitem").select(
        F.lit("9606").alias("#tax_id"), F.concat(F.lit("G"), "l_partkey").alias("GeneID"), F.lit("x").alias("more"),
        F.concat(F.lit("S"), "l_orderkey").alias("Discontinued_GeneID"), F.concat(F.lit('a"b'), "l_linenumber").alias("Discontinued_Symbol"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("Discontinue_Date"),
    )
    return T.scan_gene_history(spark, _tsv(rows))


@query("""SELECT '9606' AS "#tax_id", CAST(p_partkey AS VARCHAR) AS "GeneID", p_brand AS "Symbol", CASE WHEN p_size > 9 THEN 'NA' ELSE '-' END AS "Symbol_from_nomenclature_authority",
  replace(p_name, ' ', '|') AS "Synonyms" FROM part""")
def gene_info_scan(spark, folder):
    rows = B.table(spark, folder, "part").select(
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("Synonyms"), F.lit("9606").alias("#tax_id"), F.col("p_partkey").alias("GeneID"),
        F.col("p_brand").alias("Symbol"), F.lit("x").alias("LocusTag"), F.when(F.col("p_size") > 9, "NA").otherwise("-").alias("Symbol_from_nomenclature_authority"),
    )
    return T.scan_gene_info(spark, _tsv(rows))


@query("""SELECT 'H:' || o_orderkey AS "HGNC_ID", 'Entry Withdrawn' AS "STATUS", 'W' || o_custkey AS "WITHDRAWN_SYMBOL",
  CASE WHEN o_orderstatus <> 'F' THEN 'H:1|S' || o_custkey || '|Approved' END AS targets FROM orders""")
def withdrawn_symbols_scan(spark, folder):
    target = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("H:1|S"), "o_custkey", F.lit("|Approved")))
    rows = B.table(spark, folder, "orders").select(
        F.concat(F.lit("H:"), "o_orderkey").alias("HGNC_ID"), F.lit("Entry Withdrawn").alias("STATUS"),
        F.concat(F.lit("W"), "o_custkey").alias("WITHDRAWN_SYMBOL"), target.alias(T.HGNC_TARGETS),
    )
    return T.scan_withdrawn_symbols(spark, _tsv(rows))


@query("""SELECT 'H:' || c_custkey AS hgnc_id, 'C' || c_custkey AS symbol, CASE WHEN c_nationkey > 8 THEN c_mktsegment || '|N' || c_nationkey END AS alias_symbol,
  CASE WHEN c_nationkey > 4 THEN 'NA' END AS prev_symbol FROM customer""")
def complete_symbols_scan(spark, folder):
    nation = F.col("c_nationkey")
    rows = B.table(spark, folder, "customer").select(
        F.concat(F.lit("H:"), "c_custkey").alias("hgnc_id"), F.lit("x").alias("locus"), F.concat(F.lit("C"), "c_custkey").alias("symbol"),
        F.when(nation > 8, F.concat("c_mktsegment", F.lit("|N"), nation)).alias("alias_symbol"), F.when(nation > 4, "NA").alias("prev_symbol"),
    )
    return T.scan_complete_symbols(spark, _tsv(rows))


@query("""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
body AS (SELECT * FROM lines WHERE pos > 1 AND trim(line) <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS back FROM body)
SELECT doc_id, pos, line FROM ranked WHERE back > 2""")
def skip_head_tail(spark, folder):
    """Lines of each document without the first, the blank ones and the last two."""
    docs = B.table(spark, folder, "documents")
    kept = R.trim_text(F.col("text"), 1, 2, lambda line: F.trim(line) != "")
    return docs.select("doc_id", F.inline(kept))


@query("""WITH ranked AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem),
body AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC) AS back FROM ranked WHERE n > 3 AND l_partkey % 5 <> 0)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM body WHERE back > 2""")
def trim_groups(spark, folder):
    """Rows of each supplier without the first three, those left out by a filter, and the last two."""
    rows = B.table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return R.trim_rows(rows, "l_suppkey", ["l_orderkey", "l_linenumber"], 3, 2, F.col("l_partkey") % 5 != 0)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_nationkey > 5 THEN c_name || '"' || c_nationkey END AS name,
  CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS segment FROM customer""")
def tsv_round_trip(spark, folder):
    """Short rows and stray quotes in tab-separated text with a header per file."""
    rows = B.table(spark, folder, "customer")
    name = F.when(F.col("c_nationkey") > 5, F.concat("c_name", F.lit('"'), "c_nationkey"))
    columns = rows.select(F.col("c_custkey").cast("string").alias("id"), name.alias("name"), F.when(name.isNotNull(), F.col("c_mktsegment")).alias("segment"))
    path = work_folder(spark)
    # concat_ws leaves NULL columns out, which makes the row short
    line = F.concat_ws("\t", "id", "name", "segment").alias("value")
    columns.select(line).write.option("header", True).option("quote", "").csv(path, sep="\u0001")
    return T.scan_processed(spark, path, ["id", "name", "segment"])


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(translate(text, chr(9) || chr(10) || chr(13), '   '), '') AS text, lang FROM documents""")
def tsv_export(spark, folder):
    """Whole texts exported as tab-separated lines and read back."""
    rows = B.table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    path = work_folder(spark)
    write_tsv(rows, path)
    return T.scan_export(spark, path, ["doc_id", "text", "lang"])


@query("""WITH entries AS (
  SELECT replace(c_name, '#', '_') AS datasource, unnest(['release', 'date', 'url', 'file_names']) AS key,
    unnest([CAST(c_nationkey AS VARCHAR), NULL, 'http://x/?a=' || c_custkey, c_name || '_a.tsv,' || c_name || '_b.tsv']) AS value FROM customer)
SELECT datasource, key, value, NULL AS item FROM entries
UNION ALL SELECT datasource, 'item', NULL, unnest(string_split(value, ',')) FROM entries WHERE key = 'file_names'""")
def manifest_scan(spark, folder):
    """Customers as sources, each with a manifest file in a folder of its name."""
    text = F.concat(
        F.lit("release="), "c_nationkey", F.lit("\ndate=\n\nurl=http://x/?a="), "c_custkey",
        F.lit("\nfile_names="), "c_name", F.lit("_a.tsv,"), "c_name", F.lit("_b.tsv\n"),
    )
    path = work_folder(spark)
    rows = B.table(spark, folder, "customer").select(F.replace("c_name", F.lit("#"), F.lit("_")).alias("name"), text.alias("value"))
    staged(_for_files(rows, "name").mapInPandas(_manifest_writer(path), "n long"))
    manifest = staged(M.scan_manifest(spark, f"{path}/*/config"))
    items = M.manifest_list(manifest, "file_names")
    items = items.select("datasource", F.lit("item").alias("key"), F.lit(None).cast("string").alias("value"), "item")
    return manifest.withColumn("item", F.lit(None).cast("string")).unionByName(items)


def _manifest_writer(folder: str):
    def run(batches):
        system, inner = _place(folder)
        for batch in batches:
            for name, text in zip(batch["name"], batch["value"]):
                system.create_dir(f"{inner}/{name}", recursive=True)
                with system.open_output_stream(f"{inner}/{name}/config") as out:
                    out.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return run


@query("""SELECT 'Q' || c_custkey AS "primaryID", CASE WHEN c_nationkey > 3 THEN 'Q' || (c_custkey + 100) END AS "secondaryID", c_name AS name,
  CASE WHEN c_nationkey > 9 THEN c_mktsegment END AS synonym FROM customer""")
def query_result_scan(spark, folder):
    rows = B.table(spark, folder, "customer")
    iri, nation = F.lit("<http://www.wikidata.org/entity/Q"), F.col("c_nationkey")

    def entity(n):
        return F.concat(iri, n, F.lit(">"))

    def text(c):
        return F.concat(F.lit('"'), c, F.lit('"@en'))

    table = rows.select(
        entity(F.col("c_custkey")).alias("?primaryID"),
        F.when(nation > 3, entity(F.col("c_custkey") + 100)).alias("?secondaryID"),
        text(F.col("c_name")).alias("?name"),
        F.when(nation > 9, text(F.col("c_mktsegment"))).alias("?synonym"),
    )
    return T.scan_query_result(spark, _tsv(table))


@query("""SELECT CASE WHEN doc_id % 3 = 0 THEN '# note' WHEN doc_id % 3 = 1 THEN 'id' ELSE lang END AS id, CASE WHEN doc_id % 3 = 1 THEN 'lang' ELSE source END AS lang FROM documents""")
def export_keeps_odd_rows(spark, folder):
    """Rows that look like a comment or like the header line come back from an export."""
    k = F.col("doc_id") % 3
    rows = B.table(spark, folder, "documents").select(
        F.when(k == 0, "# note").when(k == 1, "id").otherwise(F.col("lang")).alias("id"), F.when(k == 1, "lang").otherwise(F.col("source")).alias("lang"),
    )
    path = work_folder(spark)
    write_tsv(rows, path)
    return T.scan_export(spark, path, ["id", "lang"])


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_nationkey > 5""")
def table_rebuild(spark, folder):
    """A table written over an older one: nothing of that is left."""
    rows = B.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), "c_nationkey")
    path = work_folder(spark)
    write_table(rows.repartition(5), path)
    write_table(rows.where("c_nationkey > 5").drop("c_nationkey"), path)
    return spark.read.parquet(path)
