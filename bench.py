"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local threads. Every query is forced in full through the
`noop` sink. One small query runs first so that session start-up is not counted.
"""

from __future__ import annotations

import json
import os
import time

from kinfold.queries import catalog  # noqa: F401
from kinfold.queries.registry import QUERIES
from kinfold.session import build_session

HEADLINE = [
    "src_jsonl_records", "gate_registered_source", "outcome_split", "json_affected_ids", "doc_entity_hash",
    "resolve_entities", "resolve_relationships", "resolve_search", "resolve_add_affected", "entity_docs",
    "report_source_summary", "mart_change_gate", "mart_sync_pass", "dead_letter_converge", "route_errors",
    "stream_feeder_outcomes", "stream_resolve", "commit_prefix", "failure_streaks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session("kinfold-bench", cpus)
    QUERIES["log_bounds"](spark, folder).collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    records = spark.read.parquet(f"{folder}/documents.parquet").count()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "resolve_records_per_sec": round(records / times["resolve_entities"], 1),
    }))


if __name__ == "__main__":
    main()
