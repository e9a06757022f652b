"""Parcel tracking analytics on Spark: journeys, stuck and misrouted parcels, reports, live state."""
