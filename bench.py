"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace import plans
from millrace.session import build_session

HEADLINE = [
    "daily_uv",
    "agg_bitmap_distinct",
    "agg_status_sequence",
    "agg_grouping_sets",
    "agg_salted",
    "word_count",
    "anagram_groups",
    "join_multi",
    "join_asof",
    "join_interval",
    "join_skew_split",
    "win_rank",
    "win_frames",
    "threshold_crossing",
    "topn_per_group",
    "next_higher",
    "dedup_latest",
    "doc_bulk",
    "tbl_merge",
    "term_completion",
    "querylog_lineage",
    "ddl_bucketed_join",
    "stream_tumbling_count",
    "stream_running_count",
    "stream_timer_event",
    "stream_interval_join",
]
# rows that enter the queries reported as rows per second too
RATES = {
    "stream_running_count": "true",
    "stream_timer_event": "true",
    "stream_interval_join": "event_type IN ('click', 'purchase')",
    "agg_bitmap_distinct": "true",
    "doc_bulk": "true",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.python.unix.domain.socket.enabled": "true",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="millrace-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one cheap run so that JVM and Python start-up are in no figure
    plans.QUERIES["daily_uv"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, rates = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if name in RATES:
            rows = spark.read.parquet(f"{folder}/events.parquet").where(RATES[name]).count()
            rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
