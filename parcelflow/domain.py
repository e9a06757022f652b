"""Names, table schemas and default parameters shared by every module.

Absence is never NULL in a stored table: strings default to ``''``, numbers to 0, arrays to
``[]`` and enum columns to their ``*_UNSPECIFIED`` name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values. These names, labels and thresholds have to equal the tracked system's own, or
# stored data and results would not line up with it.
# ---------------------------------------------------------------------------------------------

STATION_TYPES = (
    "STATION_TYPE_UNSPECIFIED",
    "STATION_TYPE_INTAKE",
    "STATION_TYPE_SORT_A",
    "STATION_TYPE_SORT_B",
    "STATION_TYPE_DISPATCH",
    "STATION_TYPE_INDUCTION",
    "STATION_TYPE_QC_CHECK",
    "STATION_TYPE_STAGING",
)

ROUTE = (
    "STATION_TYPE_INTAKE",
    "STATION_TYPE_INDUCTION",
    "STATION_TYPE_SORT_A",
    "STATION_TYPE_SORT_B",
    "STATION_TYPE_QC_CHECK",
    "STATION_TYPE_STAGING",
    "STATION_TYPE_DISPATCH",
)

SCAN_RESULTS = (
    "SCAN_RESULT_UNSPECIFIED",
    "SCAN_RESULT_OK",
    "SCAN_RESULT_DAMAGE_DETECTED",
    "SCAN_RESULT_UNREADABLE",
)

DAMAGE_TYPES = (
    "DAMAGE_TYPE_UNSPECIFIED",
    "DAMAGE_TYPE_CRUSHED",
    "DAMAGE_TYPE_TORN",
    "DAMAGE_TYPE_WET",
    "DAMAGE_TYPE_LEAKING",
    "DAMAGE_TYPE_OTHER",
)

ALERT_TYPES = (
    "ALERT_TYPE_UNSPECIFIED",
    "ALERT_TYPE_STUCK_PACKAGE",
    "ALERT_TYPE_DAMAGE",
    "ALERT_TYPE_MISROUTING",
)

SEVERITIES = (
    "SEVERITY_UNSPECIFIED",
    "SEVERITY_INFO",
    "SEVERITY_WARNING",
    "SEVERITY_CRITICAL",
)

ROUTING_ACTIONS = (
    "ROUTING_ACTION_UNSPECIFIED",
    "ROUTING_ACTION_PROCEED",
    "ROUTING_ACTION_REROUTE",
    "ROUTING_ACTION_HOLD",
    "ROUTING_ACTION_FLAG_FOR_REVIEW",
)

ITEM_CATEGORIES = (
    "ITEM_CATEGORY_UNSPECIFIED",
    "ITEM_CATEGORY_ELECTRONICS",
    "ITEM_CATEGORY_APPAREL",
    "ITEM_CATEGORY_HOME_GOODS",
    "ITEM_CATEGORY_GROCERY",
    "ITEM_CATEGORY_BOOKS_MEDIA",
    "ITEM_CATEGORY_TOYS",
    "ITEM_CATEGORY_HEALTH_BEAUTY",
    "ITEM_CATEGORY_AUTOMOTIVE",
    "ITEM_CATEGORY_OTHER",
)

PARCEL_STATUSES = (
    "PARCEL_STATUS_UNSPECIFIED",
    "PARCEL_STATUS_IN_TRANSIT",
    "PARCEL_STATUS_DELAYED",
    "PARCEL_STATUS_STUCK",
)

STATION_LABELS = {
    "STATION_TYPE_INTAKE": "Intake",
    "STATION_TYPE_INDUCTION": "Induction",
    "STATION_TYPE_SORT_A": "Sort A",
    "STATION_TYPE_SORT_B": "Sort B",
    "STATION_TYPE_QC_CHECK": "QC Check",
    "STATION_TYPE_STAGING": "Staging",
    "STATION_TYPE_DISPATCH": "Dispatch",
}

ITEM_CATEGORY_LABELS = {
    "ITEM_CATEGORY_UNSPECIFIED": "Other",
    "ITEM_CATEGORY_ELECTRONICS": "Electronics",
    "ITEM_CATEGORY_APPAREL": "Apparel",
    "ITEM_CATEGORY_HOME_GOODS": "Home Goods",
    "ITEM_CATEGORY_GROCERY": "Grocery",
    "ITEM_CATEGORY_BOOKS_MEDIA": "Books & Media",
    "ITEM_CATEGORY_TOYS": "Toys",
    "ITEM_CATEGORY_HEALTH_BEAUTY": "Health & Beauty",
    "ITEM_CATEGORY_AUTOMOTIVE": "Automotive",
    "ITEM_CATEGORY_OTHER": "Other",
}

ALERT_TYPE_LABELS = {
    "ALERT_TYPE_UNSPECIFIED": "Unknown",
    "ALERT_TYPE_STUCK_PACKAGE": "Stuck",
    "ALERT_TYPE_DAMAGE": "Damage",
    "ALERT_TYPE_MISROUTING": "Misrouted",
}

SEVERITY_LABELS = {
    "SEVERITY_UNSPECIFIED": "unspecified",
    "SEVERITY_INFO": "info",
    "SEVERITY_WARNING": "warning",
    "SEVERITY_CRITICAL": "critical",
}

DAMAGE_TYPE_LABELS = {
    "DAMAGE_TYPE_UNSPECIFIED": "Unspecified",
    "DAMAGE_TYPE_CRUSHED": "Crushed",
    "DAMAGE_TYPE_TORN": "Torn",
    "DAMAGE_TYPE_WET": "Wet",
    "DAMAGE_TYPE_LEAKING": "Leaking",
    "DAMAGE_TYPE_OTHER": "Other",
}

FLAG_ALERT_TYPES = ("ALERT_TYPE_MISROUTING", "ALERT_TYPE_DAMAGE")
PARCEL_SORT_FIELDS = ("dwell_time", "detected_at", "package_id")
RANGE_PRESET_DAYS = {"today": 1, "week": 7, "month": 30}
CSV_HEADER = ("Parcel ID", "Issue", "Station", "Detected At")

# Texts, ids and formats.
MISROUTING_ID = "misrouting-"
MISROUTING_EXPECTED = "Package journey diverged from expected path: expected "
MISROUTING_OBSERVED = ", observed path ends at "
STUCK_ID = "stuck-"
STUCK_AT = "Package stuck at "
STUCK_FOR = " for {threshold} with no further scan"
SEED_ID = "seed-"
REASON_DAMAGE = "damage detected: "
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
REASON_UNREADABLE = "barcode unreadable, needs manual identification"
REASON_FINAL_STATION = "package has reached final station"

# Attribute of an alert whose path is only the head of a very long one: the number of scans. Our own.
PATH_SCANS = "path_scans"


@dataclass(frozen=True)
class Params:
    """Default thresholds, all in milliseconds unless the name says otherwise."""

    stuck_threshold_ms: int = 600_000
    delayed_threshold_ms: int = 300_000
    at_risk_fraction: float = 0.8
    max_out_of_orderness_ms: int = 30_000
    session_gap_ms: int = 1_200_000
    allowed_lateness_ms: int = 300_000
    flag_lookback_ms: int = 3_600_000
    station_alert_window_ms: int = 300_000
    position_stale_ms: int = 1_800_000
    damage_window_ms: int = 600_000
    damage_sample_ms: int = 15_000
    queue_window_ms: int = 1_800_000
    queue_sample_ms: int = 20_000
    case_half_width_ms: int = 1_800_000
    detail_match_ms: int = 1_000
    alert_retention_days: int = 90
    list_parcels_max: int = 200
    recent_flagged: int = 20
    live_alert_cap: int = 100
    live_event_cap: int = 500
    # How long a resent scan is recognised (the scan topic's retention).
    resend_window_ms: int = 7 * 86_400_000
    station_alerts_shown: int = 10
    station_packages_shown: int = 12


DEFAULTS = Params()

# The prefix of a path that can decide a verdict is exactly one route long.
DISPATCH = ROUTE[-1]

# ---------------------------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------------------------

_S, _TS = T.StringType(), T.TimestampType()

SCAN_EVENT = T.StructType(
    [
        T.StructField("event_id", _S),
        T.StructField("package_id", _S),
        T.StructField("station", _S),
        T.StructField("scanner_id", _S),
        T.StructField("scanned_at", _TS),
        T.StructField("result", _S),
        T.StructField(
            "damage_assessment",
            T.StructType(
                [
                    T.StructField("damage_type", _S),
                    T.StructField("confidence", T.FloatType()),
                    T.StructField("image_ref", _S),
                ]
            ),
        ),
        T.StructField("attributes", T.MapType(_S, _S)),
    ]
)

LAKE_ROW = T.StructType(
    [
        T.StructField("event_id", _S),
        T.StructField("package_id", _S),
        T.StructField("station", _S),
        T.StructField("scanner_id", _S),
        T.StructField("scanned_at", _TS),
        T.StructField("result", _S),
        T.StructField("damage_type", _S),
        T.StructField("damage_confidence", T.FloatType()),
        T.StructField("item_id", _S),
    ]
)

STUCK_DETAIL = T.StructType(
    [
        T.StructField("last_scan_at", _TS),
        T.StructField("stuck_duration_seconds", T.IntegerType()),
        T.StructField("threshold_seconds", T.IntegerType()),
    ]
)
DAMAGE_DETAIL = T.StructType(
    [
        T.StructField("damage_type", _S),
        T.StructField("confidence", T.FloatType()),
        T.StructField("image_ref", _S),
    ]
)
MISROUTING_DETAIL = T.StructType(
    [
        T.StructField("expected_station", _S),
        T.StructField("actual_station", _S),
        T.StructField("path_so_far", T.ArrayType(_S)),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("alert_id", _S),
        T.StructField("package_id", _S),
        T.StructField("alert_type", _S),
        T.StructField("severity", _S),
        T.StructField("message", _S),
        T.StructField("station", _S),
        T.StructField("detected_at", _TS),
        T.StructField("stuck_detail", STUCK_DETAIL),
        T.StructField("damage_detail", DAMAGE_DETAIL),
        T.StructField("misrouting_detail", MISROUTING_DETAIL),
        T.StructField("attributes", T.MapType(_S, _S)),
    ]
)

ALERT_ROW = T.StructType(
    [
        T.StructField("alert_id", _S),
        T.StructField("package_id", _S),
        T.StructField("alert_type", _S),
        T.StructField("severity", _S),
        T.StructField("station", _S),
        T.StructField("message", _S),
        T.StructField("detected_at", _TS),
        T.StructField("stuck_duration_seconds", T.IntegerType()),
        T.StructField("threshold_seconds", T.IntegerType()),
        T.StructField("expected_station", _S),
        T.StructField("actual_station", _S),
        T.StructField("path_so_far", T.ArrayType(_S)),
        T.StructField("damage_type", _S),
        T.StructField("damage_confidence", T.FloatType()),
        T.StructField("inserted_at", _TS),
    ]
)

ROLLUP_ROW = T.StructType(
    [
        T.StructField("hour", _TS),
        T.StructField("alert_type", _S),
        T.StructField("severity", _S),
        T.StructField("station", _S),
        T.StructField("alert_count", T.LongType()),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("item_id", _S),
        T.StructField("name", _S),
        T.StructField("sku", _S),
        T.StructField("category", _S),
        T.StructField("unit_weight_kg", T.DoubleType()),
        T.StructField("stock_quantity", T.LongType()),
        T.StructField("catalog_updated_at", _TS),
    ]
)

POSITION = T.StructType(
    [
        T.StructField("package_id", _S),
        T.StructField("station", _S),
        T.StructField("updated_at", _TS),
        T.StructField("item_name", _S),
        T.StructField("item_category", _S),
        T.StructField("damage_detected", T.BooleanType()),
    ]
)

# Declared master record of a package. Nothing in the tracked system fills it.
PACKAGE = T.StructType(
    [
        T.StructField("package_id", _S),
        T.StructField("tracking_number", _S),
        T.StructField(
            "dimensions",
            T.StructType(
                [
                    T.StructField(c, T.FloatType())
                    for c in ("length_cm", "width_cm", "height_cm", "weight_kg")
                ]
            ),
        ),
        T.StructField("destination_facility_code", _S),
        T.StructField("intake_at", _TS),
        T.StructField("handling_flags", T.ArrayType(_S)),
        T.StructField("attributes", T.MapType(_S, _S)),
        T.StructField("item_id", _S),
        T.StructField("item_quantity", T.IntegerType()),
    ]
)
