"""Benchmark the headline jobs; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every DataFrame is fully executed through the ``noop`` sink (no collect).
Jobs mirror the reference's four entry points on the orders-derived daily
snapshots (5 days): daily integration, recompute at a date (forward and
reverse), diff of two dumps, report -- plus the one-pass backfill.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook import build_change_log, compare_summary, snapshot_diff, top_n, total_rows  # noqa: E402
from daybook.plans.fixtures import KEY, N_DAYS, day_of, read_table, snapshot, snapshots  # noqa: E402
from daybook.session import local_session, scratch_path  # noqa: E402
from daybook.sources.store import Store  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # warm-up (JIT, file listing caches): one diff, and two integrated days in a
    # throwaway store so the Parquet write path is warm too (not timed)
    run(snapshot_diff(snapshot(spark, sf_dir, 0), snapshot(spark, sf_dir, 1), KEY, day_of(1)))
    warm = Store(spark, scratch_path(spark, "bench-warmup"), KEY)
    for d, dump in snapshots(spark, sf_dir)[:2]:
        warm.integrate(dump, d)

    store = Store(spark, scratch_path(spark, "bench-store"), KEY, keep_snapshot_every=None)

    day_rows: list[int] = []

    def integrate_all():
        for d, dump in snapshots(spark, sf_dir):
            day_rows.append(store.integrate(dump, d)["rows"])

    timed("daily_integration_5d", integrate_all)
    timed("diff_one_day", lambda: run(snapshot_diff(snapshot(spark, sf_dir, 2), snapshot(spark, sf_dir, 3), KEY, day_of(3))))
    timed(
        "diff_one_day_hash",
        lambda: run(
            snapshot_diff(snapshot(spark, sf_dir, 2), snapshot(spark, sf_dir, 3), KEY, day_of(3), strategy="hash")
        ),
    )
    timed("backfill_5d", lambda: run(build_change_log(snapshots(spark, sf_dir), KEY)))
    # real replays: the day's own version is pruned, and the base is before or after it
    replayed = Store(spark, scratch_path(spark, "bench-replay"), KEY)
    replayed.backfill(snapshots(spark, sf_dir)[:1])
    replayed.backfill(snapshots(spark, sf_dir)[1:])  # versions of the first and the last day only
    timed("recompute_forward", lambda: run(replayed.as_of(day_of(2))))
    timed("recompute_reverse", lambda: run(store.undo_to(day_of(1))))
    timed("compare_summary", lambda: run(compare_summary(snapshot(spark, sf_dir, 0), snapshot(spark, sf_dir, N_DAYS - 1), KEY)))

    def report():
        latest = store.read_snapshot()
        run(total_rows(latest))
        run(top_n(read_table(spark, sf_dir, "customer"), "c_nationkey", 20))
        run(top_n(read_table(spark, sf_dir, "part"), "p_brand", 10))
        run(top_n(read_table(spark, sf_dir, "documents"), "source", 10))

    timed("report", report)

    # Not in the headline total (kept comparable across rounds): the same five
    # days into a bucketed store, whose diffs and key checks need no shuffle.
    bucketed = Store(spark, scratch_path(spark, "bench-bucketed"), KEY, buckets=int(cpus) * 2)
    t0 = time.perf_counter()
    for d, dump in snapshots(spark, sf_dir):
        bucketed.integrate(dump, d)
    bucketed_sec = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "daybook_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "integration_sec_per_day": round(times["daily_integration_5d"] / N_DAYS, 3),
                "integration_rows_per_day": round(sum(day_rows) / len(day_rows)),
                "bucketed_integration_5d": bucketed_sec,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
