"""Date ranges of the statistics requests."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date as Date
from datetime import datetime, timedelta, timezone

from parcelflow import domain
from parcelflow.functions.scalars import utc

_ISO_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


@dataclass(frozen=True)
class DateRange:
    """``report_floor`` bounds report tables (they have no upper bound), the other two bound
    timestamps, both ends included."""

    report_floor: Date
    floor: datetime
    ceiling: datetime


def resolve_range(preset: str = "", start: str = "", end: str = "", as_of: datetime | None = None) -> DateRange:
    """Two custom dates win over the preset; an unknown preset counts as one day back.

    A custom range ends at 23:59:59 of its last day. ``today`` reaches one day back, so it spans two
    calendar dates.
    """
    if start and end:
        for text in (start, end):
            if not _ISO_DATE.fullmatch(text):
                raise ValueError("start and end must be YYYY-MM-DD")
        first = utc(start)
        return DateRange(first.date(), first, utc(end) + timedelta(hours=23, minutes=59, seconds=59))
    if as_of is None:
        raise ValueError("a preset range needs as_of")
    now = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    back = timedelta(days=domain.RANGE_PRESET_DAYS.get(preset, 1))
    return DateRange(now.date() - back, now - back, now)
