"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lineside.plans.catalog import QUERIES  # noqa: E402
from lineside.plans import catalog, feeds  # noqa: E402
from lineside.sources import stored  # noqa: E402
from lineside.session import build_session, shared_dir  # noqa: E402
from lineside.streaming import landing, merging, pipeline  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "cdc_latest_per_key", "cdc_merge_apply", "cdc_key_rewrite", "direct_apply", "inspections_active",
    "station_health", "yield_by_line", "defect_counts", "incremental_refresh_delta",
    "restated_buckets", "top_defect_per_bucket", "recent_yield", "top_defects", "metrics_all",
    "q1_yield_by_line", "q2_defect_drivers", "q3_yield_vs_humidity", "defect_share", "cause_order",
    "yield_compare", "control_compare", "domain_rules", "grain_check",
)
CHANGES = 122  # size of one merge in the published figure


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def small_gates(spark) -> dict[str, float]:
    """One gate of about a hundred changes on a destination that holds the rest of the feed."""
    events = feeds.events(spark, SF_DIR)
    last = events.agg({"event_id": "max"}).first()[0] - CHANGES
    base = shared_dir(spark, "bench")
    plant = pipeline.Plant.at(spark, f"{base}/plant")
    old, new = events.where(f"event_id <= {last}"), events.where(f"event_id > {last}")
    out = {}

    def refresh(rows, batch):
        pipeline.refresh_batch(plant, feeds.journal_of(rows), feeds.telemetry_of(rows), batch)

    out["pipeline_backfill"] = timed(lambda: refresh(old, 0))
    out["pipeline_gate_122"] = timed(lambda: refresh(new, 1))
    store = merging.destination(spark, f"{base}/merge")
    out["merge_backfill"] = timed(lambda: merging.merge_batch(store, feeds.journal_of(old), 0))
    out["merge_gate_122"] = timed(lambda: merging.merge_batch(store, feeds.journal_of(new), 1))
    return out


def stored_refresh(spark) -> dict[str, float]:
    """The state that is stored before the last gate, what that gate costs then, and what building and storing all anew costs."""
    out, held = {}, []
    catalog.refresh_stored(spark, *catalog.refresh_base(spark, SF_DIR))  # as for the others, code is generated before
    out["incremental_refresh_backfill"] = timed(lambda: held.append(catalog.refresh_base(spark, SF_DIR)))
    out["incremental_refresh"] = timed(lambda: drain(catalog.refresh_stored(spark, *held[0])))
    anew = QUERIES["yield_by_line_hour"](spark, SF_DIR)
    out["full_refresh"] = timed(lambda: stored.publish(anew, f"{held[0][0]}.YIELD_ANEW", at="BUCKET"))
    return out


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["yield_by_line"](spark, SF_DIR))  # start-up and code generation are not measured
    seconds = {name: timed(lambda: drain(QUERIES[name](spark, SF_DIR))) for name in HEADLINE}
    seconds.update(stored_refresh(spark))
    seconds.update(small_gates(spark))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
