"""Seconds of the headline queries, as one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from trustlake.plans import QUERIES  # noqa: E402

HEADLINE = ["observer_coverage", "orphan_scores", "scores_per_observer", "supersede_addressable", "supersede_replaceable", "kind_histogram_top_other", "need_have_diff", "stale_ids_absence_delete", "content_routing", "url_collapse", "idle_gap_sessions", "search_bm25_trust", "observer_frontier"]
#: Over the event log, and with state.
LOG = ["log_current_events", "log_insert_rules", "log_search_tiers", "log_index_relays", "log_absence_deletions", "verified_ids", "observer_dot_product", "work_position", "ledger_snapshots", "stream_ttl_dead"]


def main() -> None:
    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
    spark = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE + LOG:
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        began = time.perf_counter()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took[n] for n in HEADLINE), 3), "log_value": round(sum(took[n] for n in LOG), 3), "unit": "sec", "queries": took, "sf": os.path.basename(d.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
