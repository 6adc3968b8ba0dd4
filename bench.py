"""Headline timings: one JSON line. Each query's result is computed in full and discarded."""

from __future__ import annotations

import json
import os
import time

from catalog.queries import QUERIES
from goldrec.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "golden_record", "survivor_rank", "exact_match", "fuzzy_match", "br_status", "dq_warning",
    "flatten_provider", "payload_build", "payload_pivot", "payload_pivot_noshuffle",
    "payload_roundtrip", "null_report", "new_batch_anti", "gate_provider", "merge_upsert",
    "bronze_ingest", "export_log_rows", "mart_state", "mart_summary", "mart_gender",
    "mart_taxonomy", "mart_rules", "mart_dq", "kpi_row", "q14_recent", "q23_license", "q26_top5",
    "q35_state_gender", "latest_rows", "landing_distributions", "load_by_name", "cdc_run",
    "materialised_models", "layer_counts", "merge_written", "mart_incremental", "field_match_score",
]


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run("golden_record")  # start-up and class loading are not measured
    seconds = {name: round(min(run(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "total of the fastest runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
