"""Nested documents by paths, and builds that a folder of manifests describes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from idtrail.plans.manifests import lacking, publish_all
from idtrail.queries import base as B, scanning as S
from idtrail.queries.base import query
from idtrail.queries.publishing import NAMES_SET
from idtrail.queries.scanning import PART_RECORDS, part_records
from idtrail.session import staged, work_folder
from idtrail.sources.paths import xml_columns

# ---- paths

PATHS = {
    "id": "@id", "name": "name", "name_lang": "name/@lang", "words": "names/word[]", "first_word": "names/word",
    "sizes": "measures/measure[]/value[]", "units": "measures/measure[]/@unit", "status": "status",
}


@query("""SELECT p_partkey::VARCHAR AS id, p_brand AS name, CASE WHEN p_size > 20 THEN 'en' END AS name_lang,
  array_to_string(string_split(p_name, ' '), '|') AS words, string_split(p_name, ' ')[1] AS first_word,
  CASE WHEN p_size < 10 THEN '' ELSE p_size || '|' || (p_size + 1) || '|' || p_type || ' & <more>' END AS sizes,
  CASE WHEN p_size < 10 THEN '' ELSE 'cm|none' END AS units, NULL::VARCHAR AS status FROM part""")
def xml_paths(spark, folder):
    """Parts as nested documents: attributes, prefixed names, repeated nodes below repeated ones, CDATA, blank nodes."""
    size = F.col("p_size")
    words = F.concat_ws("", F.transform(F.split("p_name", " "), lambda w: F.concat(F.lit("<p:word> "), w, F.lit("\n</p:word><p:word/>"))))
    measures = F.when(size < 10, "<measures/>").otherwise(F.concat(
        F.lit('<measures><measure unit="cm"><value>'), size, F.lit("</value><value>"), size + 1,
        F.lit('</value></measure><measure unit="none"><!-- <value>0</value> --><value><![CDATA['), "p_type", F.lit(" & <more>]]></value></measure></measures>"),
    ))
    text = F.concat(
        F.lit('<part xmlns="http://x/" xmlns:p="http://p/" id="'), "p_partkey", F.lit('"><p:name'), F.when(size > 20, ' lang="en"').otherwise(""),
        F.lit(">"), "p_brand", F.lit("</p:name><names>"), words, F.lit("</names>"), measures, F.lit("<status>  </status></part>"),
    )
    found = xml_columns(B.table(spark, folder, "part").select(text.alias("value")), PATHS).drop("value")
    return found.withColumns({c: F.array_join(c, "|") for c in ("words", "sizes", "units")})


# ---- builds by manifest


def _source_writer(folder: str):
    """Writes ``config`` and, where there is some, ``data/<file>`` of each source."""

    def run(batches):
        system, inner = S._place(folder)
        for batch in batches:
            for name, config, file in zip(batch["name"], batch["config"], batch["file"]):
                system.create_dir(f"{inner}/{name}/data", recursive=True)
                with system.open_output_stream(f"{inner}/{name}/config") as out:
                    out.write(config.encode())
                if file:
                    with system.open_output_stream(f"{inner}/{name}/data/{file}") as out:
                        out.write(b"x")
            yield pd.DataFrame({"n": [len(batch)]})

    return run


@query("""WITH s AS (SELECT replace(c_name, '#', '_') AS datasource, c_custkey AS k FROM customer)
SELECT datasource, 'key' AS kind, 'date' AS item FROM s WHERE k % 5 = 0 UNION ALL SELECT datasource, 'key', 'url' FROM s WHERE k % 11 = 0
UNION ALL SELECT datasource, 'value', 'info' FROM s WHERE k % 3 = 0 UNION ALL SELECT datasource, 'file', datasource || ' a+b.gz' FROM s WHERE k % 7 = 0""")
def manifest_absent(spark, folder):
    """Customers as sources: some have no date, some no address, some an input without a file name, some a file that is not there."""
    key, name = F.col("c_custkey"), F.replace("c_name", F.lit("#"), F.lit("_"))
    config = F.concat(
        F.lit("release=\ndate="), F.when(key % 5 == 0, "").otherwise("2024-01-31"), F.when(key % 11 != 0, "\nurl=http://x/").otherwise(""),
        F.lit("\ninputs=history:"), name, F.lit(" a+b.gz,taxon:9606"), F.when(key % 3 == 0, ",info:").otherwise(""), F.lit("\n"),
    )
    file = F.when(key % 7 != 0, F.concat(name, F.lit(" a+b.gz")))
    path = work_folder(spark)
    rows = B.table(spark, folder, "customer").select(name.alias("name"), config.alias("config"), file.alias("file"))
    staged(S._for_files(rows, "name").mapInPandas(_source_writer(path), "n long"))
    return lacking(spark, path).where("kind <> 'source'")


@query(f"""WITH {PART_RECORDS},
edges AS (SELECT "primaryID", unnest(secondary) AS "secondaryID" FROM records), {B.CLASSED},
names AS (SELECT "primaryID", name, unnest(synonyms) AS synonym FROM records)
{NAMES_SET}""")
def manifest_build(spark, folder):
    """Two sources in a folder of manifests: the one that has all it needs is published from there, the other one told as absent."""
    path = work_folder(spark)
    configs = spark.createDataFrame(
        [("chebi", "release=223\ndate=2024-01-31\nurl=http://c/\ninputs=sdf:records.sdf\n", None), ("ncbi", "date=2024-01-31\nurl=http://n/\ninputs=history:h.gz\n", None)],
        "name string, config string, file string",
    )
    staged(configs.mapInPandas(_source_writer(path), "n long"))
    part_records(spark, folder).select(S._sdf_text().alias("value")).write.text(f"{path}/chebi/data/records.sdf")
    tables = publish_all(spark, path, work_folder(spark))
    if list(tables) != ["ChEBI"]:
        raise ValueError(f"built: {', '.join(tables)}")
    return tables["ChEBI"]["sssom"]
