"""Schemas of the tables the workflow reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    """``name type`` pairs; names may hold dots."""
    kinds = {
        "string": T.StringType(),
        "double": T.DoubleType(),
        "int": T.IntegerType(),
        "timestamp": T.TimestampType(),
    }
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, kinds[kind], True))
    return T.StructType(fields)


PROJECTION = _schema(
    "meas string, reg string, bldg_type string, end_use string, fuel string, "
    "year int, tech_stage string, state_ann_kwh double, turnover string, "
    "sector string, run_id string"
)
ANNUAL_MULTIPLIERS = {
    "res": _schema(
        "in.county string, in.weather_file_city string, "
        "in.weather_file_longitude string, group_ann string, "
        "multiplier_annual double, sector string, in.state string, "
        "end_use string, fuel string"
    ),
    "com": _schema(
        "in.county string, group_ann string, multiplier_annual double, "
        "sector string, in.state string, end_use string, fuel string"
    ),
}
HOURLY_MULTIPLIERS = {
    "res": _schema(
        "in.weather_file_city string, shape_ts string, timestamp_hour timestamp, "
        "kwh double, multiplier_hourly double, sector string, "
        "in.weather_file_longitude string, fuel string, end_use string"
    ),
    "com": _schema(
        "in.county string, shape_ts string, timestamp_hour timestamp, kwh double, "
        "multiplier_hourly double, sector string, fuel string, end_use string, "
        "in.state string"
    ),
}
COUNTY_ANNUAL = _schema(
    "in.county string, fuel string, meas string, tech_stage string, "
    "multiplier_annual double, state_ann_kwh double, turnover string, "
    "county_ann_kwh double, run_id string, end_use string, sector string, "
    "year int, in.state string"
)
COUNTY_HOURLY = _schema(
    "in.county string, timestamp_hour timestamp, turnover string, "
    "county_hourly_uncal_kwh double, run_id string, end_use string, fuel string, "
    "sector string, year int, in.state string"
)
CALIBRATION = _schema(
    "sector string, in.state string, month int, fuel string, "
    "calibration_multiplier double"
)

# Folder columns of each table, coarse to fine.
PARTITIONS = {
    "annual_multipliers": ("end_use", "in.state"),
    "hourly_multipliers_res": ("end_use",),
    "hourly_multipliers_com": ("end_use", "in.state"),
    "county_annual": ("end_use", "in.state"),
    "long_county": ("sector", "year", "in.state"),
    "air_quality": ("turnover", "in.state"),
}
