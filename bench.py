"""Headline timings as one JSON line: BENCH_SF_DIR (folder), BENCH_CPUS (local threads)."""

import json
import os
import time

import queries as registered
from ringside.operators import history
from ringside.session import build_session
from ringside.sources.binding import bench

# builds are timed from their written inputs; queries read the written layers
BUILDS = ["placed", "bouts", "events", "stored_corner_facts", "stored_features", "stored_model_rows"]
HEADLINES = ["corner_facts", "round_facts", "opponent_asof", "training_rows", "pick_ledger_summary",
             "audit_absorbed_mismatch", "audit_round_count_gaps", "win_baselines", "view_null_rates"]


def timed(run) -> float:
    start = time.time()
    run()
    return round(time.time() - start, 2)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("ringside-bench", cpus=int(os.environ.get("BENCH_CPUS", "8")))
    tables = bench(spark, folder)
    timings = {f"build_{name}": timed(lambda n=name: getattr(tables, n)) for name in BUILDS}
    rows = history.load_history(tables.stored_corner_facts)
    timings["windows_only"] = timed(
        lambda: history.own_features(rows).write.format("noop").mode("overwrite").save())
    for name in HEADLINES:
        timings[name] = timed(
            lambda n=name: registered.QUERIES[n](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total wall-clock of builds and headline queries", "value": round(sum(timings.values()), 2),
        "unit": "sec", "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
