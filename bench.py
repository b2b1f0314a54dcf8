"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
BENCH_QUERIES may list query names to run instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusgraph.plans import QUERIES  # noqa: E402
from corpusgraph.session import session  # noqa: E402

HEADLINE = [
    "top_connected", "hubs", "entity_stats", "classify",
    "dated_events", "case_membership", "case_events", "entity_events",
    "phrase_candidates", "gazetteer_mentions", "hierarchy", "series", "upsert_latest",
    "build_links", "excerpts", "degree", "tiers", "components", "shortest_path", "siblings", "visible_links",
    "tag_pairs", "venn_assign", "timelapse_frames",
    "term_search", "bm25_fuzzy", "snippets", "cosine_topk", "richtext_blocks", "stream_daily",
    "notes_scan", "similar_notes", "stream_upsert",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            # Small test tables, CPU-bound steps: keep one partition per core.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
