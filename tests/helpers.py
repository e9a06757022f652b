"""Small inputs and brute-force versions of the per-package rules, in plain Python."""

from __future__ import annotations

from datetime import datetime, timezone

from parcelflow import domain
from parcelflow.functions.scalars import to_millis

BASE = 1_700_000_000_000
STATION = {s[0]: f"STATION_TYPE_{s}" for s in ("INTAKE", "QC_CHECK", "DISPATCH")}
STATION |= {
    "N": "STATION_TYPE_INDUCTION",
    "A": "STATION_TYPE_SORT_A",
    "B": "STATION_TYPE_SORT_B",
    "S": "STATION_TYPE_STAGING",
}
GAP = domain.DEFAULTS.session_gap_ms
SCHEMA = "event_id string, package_id string, station string, scanned_at timestamp, result string, item_id string"


def at(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc)


def path(letters: str) -> list[str]:
    return [STATION[x] for x in letters]


def scan(package: str, station: str, ms: int, event: str | None = None, result: str = "SCAN_RESULT_OK", item: str = ""):
    return (event or f"e-{package}-{ms}", package, STATION.get(station, station), at(ms), result, item)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def journey(spark, letters: str, package: str = "p", step: int = 500, start: int = BASE):
    return frame(spark, [scan(package, x, start + i * step) for i, x in enumerate(letters)])


def _ordered(rows):
    by_package: dict[str, list] = {}
    for event, package, station, when, *_ in rows:
        by_package.setdefault(package, []).append((to_millis(when), event, station))
    return {p: sorted(scans) for p, scans in by_package.items()}


def brute_sessions(rows, gap=GAP):
    """``(package, start, last, count, path)`` per session."""
    found = []
    for package, scans in _ordered(rows).items():
        current = []
        for s in scans:
            if current and s[0] - current[-1][0] > gap:
                found.append((package, current))
                current = []
            current.append(s)
        found.append((package, current))
    return sorted((p, c[0][0], c[-1][0], len(c), [x[2] for x in c]) for p, c in found)


def brute_stuck(rows, threshold, watermark):
    found = []
    for package, scans in _ordered(rows).items():
        for i, (ms, _, station) in enumerate(scans):
            quiet = i + 1 == len(scans) or scans[i + 1][0] - ms > threshold
            if quiet and ms + threshold <= watermark:
                found.append((package, station, ms))
    return sorted(found)


def random_rows(rng, packages=6, scans=120, span=6 * 3_600_000, grain=1):
    """Unsorted scans with ties on purpose when ``grain`` is coarse."""
    rows = []
    for i in range(scans):
        ms = BASE + rng.randrange(0, span // grain) * grain
        rows.append(scan(f"p{rng.randrange(packages)}", rng.choice("INABQSD"), ms, event=f"e{i:05d}"))
    return rows
