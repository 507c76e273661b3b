"""Rows that don't fit, rebuilds, differences of builds, and exports that are read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from idtrail.functions import vocab as V
from idtrail.operators import cardinality as K, changes as D, sssom as S
from idtrail.plans import profiles as P
from idtrail.plans.build import observed
from idtrail.queries import base as B
from idtrail.queries.base import query
from idtrail.queries.publishing import LABEL_PAIRS, label_pairs
from idtrail.session import remove_folder, staged, work_folder
from idtrail.sinks import versions as R
from idtrail.sinks.tables import FILE_ROWS, write_observed, write_sssom
from idtrail.sources import tabular as T

# ---- ragged rows

RAGGED = """ragged AS (
  SELECT c_custkey AS k, c_custkey || chr(9) || c_name || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE chr(9) || c_mktsegment END
    || CASE WHEN c_custkey % 7 = 0 THEN chr(9) || 'more' || chr(9) || c_nationkey ELSE '' END AS line,
    CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 3 END + CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 0 END AS n FROM customer)"""


def _ragged(spark, folder, whole: bool = False) -> str:
    """Customers as tab-separated text; every fifth lacks a cell, every seventh has two too many. With ``whole`` those are left out."""
    key = F.col("c_custkey")
    cells = F.concat_ws("\t", key, "c_name", F.when(key % 5 != 0, F.col("c_mktsegment")), F.when(key % 7 == 0, F.concat_ws("\t", F.lit("more"), "c_nationkey")))
    rows = B.table(spark, folder, "customer")
    lines = (rows.where(key % 7 != 0) if whole else rows).select(cells.alias("value"))
    path = work_folder(spark)
    # each part file has its header, as the files of a source do
    lines.withColumnRenamed("value", "id\tname\tsegment").write.option("quote", "").option("escape", "").option("sep", "\u0001").csv(path, header=True)
    return path


@query(f"""WITH {RAGGED} SELECT line, n AS n_cells, 3 AS n_columns FROM ragged WHERE n > 3""")
def tsv_rejects(spark, folder):
    """Rows with more cells than the header, as they stand in the file."""
    return T.tsv_rejects(spark, _ragged(spark, folder)).drop("file")


@query(f"""WITH {RAGGED} SELECT line, n AS n_cells, 3 AS n_columns FROM ragged WHERE n <> 3""")
def tsv_short_and_long_rows(spark, folder):
    return T.tsv_rejects(spark, _ragged(spark, folder), short_rows=True).drop("file")


@query(f"""WITH {RAGGED}, cells AS (SELECT string_split(line, chr(9)) AS c FROM ragged WHERE n <= 3) SELECT c[1] AS id, c[2] AS name, c[3] AS segment FROM cells""")
def tsv_without_rejects(spark, folder):
    """The loose scan: short rows filled, long ones left out (and told by ``tsv_rejects``)."""
    return T.scan_tsv(spark, _ragged(spark, folder), long_rows="reject")


@query("""SELECT 'as they are' AS files, 'refused' AS outcome, NULL::BIGINT AS n UNION ALL SELECT 'without long rows', 'read', count(*) FROM customer WHERE c_custkey % 7 <> 0""")
def tsv_strict_scan(spark, folder):
    """The strict scan, which is the default, ends with an error at a row that does not fit."""
    told = []
    for name, whole in (("as they are", False), ("without long rows", True)):
        try:
            told.append((name, "read", T.scan_tsv(spark, _ragged(spark, folder, whole), ["id", "segment"]).count()))
        except Exception as e:
            if "more than 3 cells" not in str(e):
                raise
            told.append((name, "refused", None))
    return spark.createDataFrame(told, "files string, outcome string, n long")


# ---- rebuilds


def _builds(spark, folder):
    orders = B.table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_custkey")
    return orders.where("o_custkey % 3 <> 0"), orders


@query("""SELECT o_orderkey::VARCHAR AS id, o_orderstatus, o_custkey FROM orders WHERE o_custkey % 3 <> 0""")
def rebuild_that_fails(spark, folder):
    """A build that ends with an error midway, its first table already written: readers still have the build before."""
    root, (first, second) = work_folder(spark), _builds(spark, folder)
    R.write_version(spark, root, {"ids": first})
    broken = second.withColumn("id", F.when(F.col("o_custkey") % 5 == 0, F.raise_error(F.lit("input ends here"))).otherwise(F.col("id")))
    try:
        R.write_version(spark, root, {"ids": second, "names": broken})
    except Exception as e:
        if "input ends here" not in str(e):
            raise
    return R.read_version(spark, root, "ids")


@query("""SELECT 'pinned' AS reader, o_orderstatus, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 2
UNION ALL SELECT 'newest', o_orderstatus, count(*) FROM orders GROUP BY 2""")
def rebuild_beside_a_reader(spark, folder):
    """A reader keeps to the build it began with while a newer one is committed; who comes later has the newer one."""
    root, (first, second) = work_folder(spark), _builds(spark, folder)
    pinned = R.write_version(spark, root, {"ids": first})
    before = R.read_version(spark, root, "ids")
    R.write_version(spark, root, {"ids": second})
    rows = before.unionByName(R.read_version(spark, root, "ids", pinned)).distinct().withColumn("reader", F.lit("pinned"))
    rows = rows.unionByName(R.read_version(spark, root, "ids").withColumn("reader", F.lit("newest")))
    return rows.groupBy("reader", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT i::BIGINT AS number, (SELECT count(*) FROM orders WHERE o_custkey % 4 < i) AS n FROM range(3, 5) t(i)""")
def rebuild_expires(spark, folder):
    """Of four builds the two newest stay."""
    root, (_, rows) = work_folder(spark), _builds(spark, folder)
    for i in range(1, 5):
        R.write_version(spark, root, {"ids": rows.where(f"o_custkey % 4 < {i}")}, keep=2)
    left = [R.read_version(spark, root, "ids", v).agg(F.lit(v.number).cast("long").alias("number"), F.count("*").alias("n")) for v in R.versions(spark, root)]
    return left[0].unionByName(left[1])


# ---- differences

SIDES = """a AS (SELECT NULLIF(l_linenumber, 1) AS line, l_returnflag AS flag, l_suppkey AS supplier FROM lineitem WHERE l_quantity < 30),
b AS (SELECT NULLIF(l_linenumber, 1) AS line, l_returnflag AS flag, l_suppkey AS supplier FROM lineitem WHERE l_quantity >= 20)"""


def _sides(spark, folder):
    rows = B.table(spark, folder, "lineitem")
    named = [F.nullif("l_linenumber", F.lit(1)).alias("line"), F.col("l_returnflag").alias("flag"), F.col("l_suppkey").alias("supplier")]
    return rows.where("l_quantity < 30").select(*named), rows.where("l_quantity >= 20").select(*reversed(named))


@query(f"WITH {SIDES} SELECT * FROM a EXCEPT ALL SELECT * FROM b")
def except_rows_bag(spark, folder):
    return D.except_all(*_sides(spark, folder))


@query(f"WITH {SIDES} SELECT * FROM a EXCEPT SELECT * FROM b WHERE supplier % 2 = 0")
def except_rows_set(spark, folder):
    a, b = _sides(spark, folder)
    return D.except_distinct(a, b.where("supplier % 2 = 0"))


def _classed(name: str, where: str) -> str:
    return f"""{name} AS (SELECT "primaryID", "secondaryID", {B.CLASS_CASE} AS c FROM (
  SELECT *, count(*) OVER (PARTITION BY "primaryID") AS n_pri, count(*) OVER (PARTITION BY "secondaryID") AS n_sec FROM (SELECT * FROM edges_ WHERE {where})))"""


@query(f"""WITH edges_ AS (SELECT CASE WHEN l_returnflag = 'A' THEN 'Entry Withdrawn' ELSE l_partkey || '-' || l_suppkey END AS "primaryID",
  l_orderkey || '-' || l_suppkey AS "secondaryID", l_linenumber AS k FROM lineitem),
{_classed("o", "k < 5")}, {_classed("w", "k > 1")},
os AS (SELECT "primaryID", "secondaryID", string_agg(DISTINCT c, '|' ORDER BY c) AS c, count(*) AS n FROM o GROUP BY 1, 2),
ws AS (SELECT "primaryID", "secondaryID", string_agg(DISTINCT c, '|' ORDER BY c) AS c, count(*) AS n FROM w GROUP BY 1, 2)
SELECT coalesce(os."primaryID", ws."primaryID") AS "primaryID", coalesce(os."secondaryID", ws."secondaryID") AS "secondaryID",
  coalesce(os.c, '') AS old_mapping_cardinality, coalesce(ws.c, '') AS new_mapping_cardinality, coalesce(os.n, 0) AS n_old, coalesce(ws.n, 0) AS n_new,
  CASE WHEN ws.n IS NULL THEN 'gone' WHEN os.n IS NULL THEN 'come' WHEN os.c <> ws.c THEN 'changed' ELSE 'same' END AS change
FROM os FULL JOIN ws ON os."primaryID" = ws."primaryID" AND os."secondaryID" = ws."secondaryID" """)
def build_changes(spark, folder):
    """Mappings that went, came or changed their class between two builds, of overlapping lines."""
    rows = _numbered_edges(spark, folder)
    return D.build_changes(*[staged(K.with_cardinality(rows.where(test).drop("k"))) for test in ("k < 5", "k > 1")])


def _numbered_edges(spark, folder) -> DataFrame:
    return B.table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", V.WITHDRAWN).otherwise(B.current_id()).alias("primaryID"), B.old_id().alias("secondaryID"), F.col("l_linenumber").alias("k"),
    )


# ---- counts while writing


@query(f"""WITH {LABEL_PAIRS} SELECT 'label_rows' AS name, count(*) AS n FROM l UNION ALL SELECT 'mapping_rows', count(*) FROM m
UNION ALL SELECT 'unclassed', count(*) FROM m WHERE NOT regexp_full_match(coalesce(mapping_cardinality, ''), '1:1|n:1|1:n|n:n|1:0')""")
def counts_while_writing(spark, folder):
    """What the quality report needs to know of whole tables, observed in the tasks that write them."""
    counted = {}
    for name, df in zip(("mappings", "labels"), label_pairs(spark, folder), strict=True):
        counted |= write_observed(df, work_folder(spark), **observed(name, df))
    return spark.createDataFrame(sorted(counted.items()), "name string, n long")


# ---- exports

BLOCK = 500


def numbered_lines(spark, path: str, folder: str | None = None) -> DataFrame:
    """``n, value``: the lines of part files, numbered from 0 as if they were one file; they are stored in ``folder`` on the way.

    Lines are numbered in each split as it is read; only the splits' line counts are added up in one place.
    """
    block = F.struct("_metadata.file_name", "_metadata.file_block_start")
    lines = staged(spark.read.text(path).select("value", block.alias("block"), F.monotonically_increasing_id().alias("at")), folder, "zstd")
    sizes = lines.groupBy("block").agg(F.count("*").alias("size"), F.min("at").alias("first"))
    before = sizes.select(F.col("block").alias("of"), "first", (F.sum("size").over(Window.orderBy("block")) - F.col("size")).alias("before"))
    return lines.join(F.broadcast(before), F.col("block") == F.col("of")).select((F.col("before") + F.col("at") - F.col("first")).alias("n"), "value")


def _block_digests(lines: DataFrame, name: str) -> DataFrame:
    one = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]), "\n")
    return lines.groupBy(F.floor(F.col("n") / BLOCK).alias("block")).agg(F.sha2(one, 256).alias(name))


@query(f"""WITH {B.LIVE_EDGES}, {B.CLASSED},
rows_ AS (SELECT "primaryID" AS a, {B.PREDICATE_CASE} AS b, "secondaryID" AS c, mapping_cardinality AS d, {B.COMMENT_CASE} AS e FROM classed),
sorted_ AS (SELECT concat_ws(chr(9), a, b, c, d, e) AS value, row_number() OVER (ORDER BY a, b, c, d, e) + 8 AS n FROM rows_),
body AS (SELECT * FROM sorted_ UNION ALL SELECT 'subject_id' || chr(9) || 'predicate_id' || chr(9) || 'object_id' || chr(9) || 'mapping_cardinality' || chr(9) || 'comment', 8),
blocks AS (SELECT n // {BLOCK} AS block, sha256(string_agg(value, chr(10) ORDER BY n)) AS d, min(n) AS first FROM body WHERE n // {BLOCK} > 0 GROUP BY 1)
SELECT block::BIGINT AS block, d AS of_3, d AS of_17 FROM blocks""")
def stable_export(spark, folder):
    """Two exports of one mapping set, its rows dealt differently, in 3 and in 17 part files, or multiples of them: digests of the same 500 lines of each.

    Tables and exports are compressed, and each leaves the disk when what is made of it is there.
    """
    made, told, meta = [], [], P.set_metadata("UniProt", provider="lineitem")

    def stored(df: DataFrame) -> DataFrame:
        made.append(work_folder(spark))
        return staged(df, made[-1], "zstd")

    def only(df: DataFrame) -> DataFrame:
        """``df`` stored, and what was stored before it removed."""
        df = stored(df)
        while len(made) > 1:
            remove_folder(spark, made.pop(0))
        return df

    rows = K.describe_mappings(B.live_edges(spark, folder), note_retired=False, stage=stored).withColumn("source", F.lit("lineitem"))
    rows = only(S.sssom_of_plain(rows))
    for files in (3, 17):
        if files == 17:
            rows = only(rows.repartition(max(5, rows.count() // FILE_ROWS), "object_id"))
        path, numbered = work_folder(spark), work_folder(spark)
        write_sssom(rows, path, meta, files, "gzip", read=(lambda: remove_folder(spark, *made)) if files == 17 else None)
        lines = numbered_lines(spark, path, numbered)
        remove_folder(spark, path)
        told.append(staged(_block_digests(lines, f"of_{files}")))
        remove_folder(spark, numbered)
    # the first block has the header, which the SQL form does not spell out
    return told[0].join(told[1], "block").where("block > 0")


@query("""SELECT CASE WHEN doc_id % 3 = 0 THEN '# note' WHEN doc_id % 3 = 1 THEN 'subject_id' ELSE lang END AS subject_id,
  CASE WHEN doc_id % 3 = 1 THEN 'object_id' ELSE 'D:' || doc_id END AS object_id, 'Docs' AS provider, 2::BIGINT AS n_prefixes FROM documents""")
def whole_file_round_trip(spark, folder):
    """A mapping set in one file, read by what stands in it; rows that look like comments or column names stay rows."""
    k = F.col("doc_id") % 3
    rows = B.table(spark, folder, "documents").select(
        F.when(k == 0, "# note").when(k == 1, "subject_id").otherwise(F.col("lang")).alias("subject_id"),
        F.when(k == 1, "object_id").otherwise(F.concat(F.lit("D:"), "doc_id")).alias("object_id"),
    )
    parts, path = work_folder(spark), work_folder(spark)
    write_sssom(rows, parts, S.SetMetadata(prefixes={"D": "http://d/", "E": "http://e/"}, provider="Docs", comment="one file"), 4)
    lines = numbered_lines(spark, parts)
    lines.coalesce(1).sortWithinPartitions("n").select("value").write.text(path)
    meta, found = T.scan_sssom(spark, path)
    return found.withColumns({"provider": F.lit(meta["mapping_provider"]), "n_prefixes": F.lit(len(meta["curie_map"])).cast("long")})
