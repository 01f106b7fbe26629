"""Declared schemas. Sources are never inferred."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StructField, StructType, TimestampType

# The columns of the source file, in file order.
KEY = "time_tag"
MEASURES = (
    "solar_wind_speed",
    "proton_density",
    "magnetic_field_total",
    "magnetic_field_bz",
    "plasma_temperature",
)

TELEMETRY = StructType(
    [StructField(KEY, TimestampType())] + [StructField(m, DoubleType()) for m in MEASURES]
)
