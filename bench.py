"""Times the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from idtrail.queries import QUERIES
from idtrail.session import local_session

HEADLINE = [
    "described_mappings",
    "cardinality_edges",
    "cardinality_list_form",
    "withdrawn_closure",
    "merge_mappings_labels",
    "names_full_join",
    "nullsafe_two_key_join",
    "alias_typed",
    "label_suppression",
    "sdf_round_trip",
    "xml_round_trip",
    "skip_head_tail",
    "xref_nodes",
    "xref_sets",
    "redirects_by_class",
    "ncbi_mappings",
    "ncbi_sssom",
    "hgnc_sssom",
    "uniprot_mappings",
    "chebi_sssom",
    "sssom_rows",
    "quality_report",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["explode_targets"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
