"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (cores), ``BENCH_RUNS`` (timed runs per
query after one warm-up; the median counts). Every query runs over all its rows into Spark's
``noop`` sink, so nothing is cut off by an early stop or by moving results to the driver. Scans,
alerts, the lake and the reports are first stored as Parquet tables, as the system would have them;
these single runs on a cold JVM are listed apart from the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.testbed import Testbed  # noqa: E402
from parcelflow.operators import alerts as A  # noqa: E402
from parcelflow.operators import cases, dwell, floor, ingest, journeys, reports  # noqa: E402
from parcelflow.plans import api  # noqa: E402
from parcelflow.plans.ranges import resolve_range  # noqa: E402
from parcelflow.session import local_session  # noqa: E402
from parcelflow.sources import lake  # noqa: E402


class Stored(Testbed):
    """Reads scans from a stored table instead of deriving them for every query."""

    def store_scans(self) -> None:
        Testbed.scans.fget(self).write.mode("overwrite").parquet(f"{self.root}/scans")

    def store_wire(self) -> None:
        ingest.encode_scans(self.scans).write.mode("overwrite").parquet(f"{self.root}/wire")

    @property
    def scans(self):
        return self.spark.read.parquet(f"{self.root}/scans")

    @property
    def wire(self):
        return self.spark.read.parquet(f"{self.root}/wire")


def drain(*frames) -> None:
    for df in frames:
        df.write.format("noop").mode("overwrite").save()


def headline(t: Stored) -> dict:
    week = resolve_range("week", as_of=t.as_of)
    package = t.scans.groupBy("package_id").count().orderBy("count", "package_id", ascending=[False, True]).first()[0]
    return {
        "misrouting_alerts": lambda: drain(journeys.misrouting_alerts(journeys.sessions(t.scans))),
        "session_scans": lambda: drain(journeys.session_scans(t.scans)),
        "stuck_alerts": lambda: drain(dwell.stuck_alerts(t.scans)),
        "decode_scans": lambda: drain(ingest.decode_scans(t.wire)[0]),
        "routing": lambda: drain(ingest.route(t.scans, t.as_of)),
        "daily_station_throughput": lambda: drain(reports.daily_station_throughput(t.scans)),
        "daily_damage_rate_by_category": lambda: drain(reports.daily_damage_rate_by_category(t.scans, t.items)),
        "daily_reconciliation": lambda: drain(reports.daily_reconciliation(t.scans, t.alerts)),
        "hourly_rollup": lambda: drain(A.hourly_rollup(t.alerts)),
        "latest_alerts": lambda: drain(A.latest_alerts(t.alerts)),
        "facility_stats": lambda: drain(
            *api.facility_stats_from(t.spark, t.warehouse_root, t.reports_root, week).values()
        ),
        "current_positions": lambda: drain(t.positions),
        "list_parcels": lambda: drain(
            api.list_parcels_from(t.spark, t.warehouse_root, t.positions, t.as_of, limit=50).page
        ),
        "package_journey": lambda: drain(api.package_journey(t.scans, t.alerts, package).timeline),
        "lake_day": lambda: drain(lake.read_lake_day(t.spark, t.lake_root, "2026-08-10")),
        "lake_package": lambda: drain(lake.read_package_scans(t.spark, t.lake_root, package)),
        "station_moves": lambda: drain(floor.station_moves(t.scans)),
        "queue_depth": lambda: drain(floor.queue_depth(t.scans, t.as_of)),
        "damage_rate_series": lambda: drain(floor.damage_rate_series(t.scans)),
        "scans_near_alerts": lambda: drain(cases.nearby_scans(t.alerts, t.scans)),
    }


def clock(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    t = Stored(spark, sf_dir)
    setup = {
        "store_scans": clock(t.store_scans),
        "store_wire": clock(t.store_wire),
        "store_alerts": clock(lambda: t.warehouse_root),
        "store_lake": clock(lambda: t.lake_root),
        "store_reports": clock(lambda: t.throughput),
    }
    times = {}
    for name, run in headline(t).items():
        run()
        times[name] = statistics.median(clock(run) for _ in range(runs))
    times = {name: round(seconds, 3) for name, seconds in times.items()}
    total = sum(times.values())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "setup_single_cold_run": {name: round(seconds, 3) for name, seconds in setup.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "scans": t.scans.count(),
                "cpus": cpus,
                "shuffle_partitions": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
