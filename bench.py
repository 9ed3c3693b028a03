"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: threads.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from catalogue import all_queries

HEADLINES = (
    "field_profile",
    "value_distribution",
    "provider_profile",
    "duplicate_groups",
    "orphan_rows",
    "evidence_flags",
    "agreement",
    "name_collisions",
    "label_collision_profile",
    "alias_collision_profile",
    "qid_collision_members",
    "xid_collisions",
    "xid_conflicts",
    "entity_conflicts",
    "entity_xid_identity",
    "xid_quality",
    "dob_conflicts",
    "identity_evidence",
    "identity_consistency",
    "redirect_walk",
    "redirect_detail",
    "final_audit",
    "search_text_quality",
    "norm_conservative",
    "upsert_plan",
    "progress_violations",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
