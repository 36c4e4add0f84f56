"""Bike-share pipeline: raw rides -> typed, priced rides -> daily bike KPIs.

Each step is a DataFrame transformation conformed to its declared column
list (types + comments), which is what the materialized views declare.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.schema import Column, conform
from strata.sources.lake import Lake
from strata.sources.raw_files import read_text_csv

# The names and types of the views' columns.
SILVER_RIDES = [
    Column("ride_date", "date", "day on which the ride began"),
    Column("ride_id", "string", "key of the ride"),
    Column("start_time", "timestamp_ntz", "start, wall clock"),
    Column("end_time", "timestamp_ntz", "end, wall clock"),
    Column("start_station_id", "string", "station left"),
    Column("end_station_id", "string", "station reached"),
    Column("bike_id", "string", "bike ridden"),
    Column("user_type", "string", "member, casual or unknown (null)"),
    Column("ride_revenue", "decimal(19,4)", "price of the whole minutes ridden"),
]
GOLD_RIDES = [
    Column("ride_date", "date", "day"),
    Column("bike_id", "string", "bike"),
    Column("total_rides", "bigint", "number of different rides"),
    Column("total_revenue", "decimal(19,4)", "sum of their prices"),
    Column("first_start_station_id", "string", "station of the earliest start"),
    Column("last_end_station_id", "string", "station of the latest end"),
]

# Hourly prices, charged on whole minutes ridden (fixed values): members
# 10.0, everyone else - NULL user type included - 15.0.
MEMBER_RATE = Decimal("10.0")
DEFAULT_RATE = Decimal("15.0")
MINUTES_PER_HOUR = Decimal("60.0")


def bronze_rides_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder, header on, every column a string (R1)."""
    return read_text_csv(spark, folder)


def _timed(bronze: DataFrame) -> DataFrame:
    """Rides with parsed times (NULL where malformed) and their whole minutes."""
    times = {c: F.col(c).try_cast("timestamp_ntz") for c in ("start_time", "end_time")}
    minutes = F.timestamp_diff("MINUTE", F.col("start_time"), F.col("end_time"))
    return bronze.withColumns(times).withColumn("_minutes", minutes)


def rejected_rides(bronze: DataFrame) -> DataFrame:
    """The rides that ``silver_rides`` leaves out: the raw columns and a reason."""
    raw = bronze.withColumns({"raw_start_time": F.col("start_time"), "raw_end_time": F.col("end_time")})
    reason = (
        F.when(F.col("start_time").isNull(), F.lit("bad start time"))
        .when(F.col("end_time").isNull(), F.lit("bad end time"))
        .when(F.col("_minutes") <= 0, F.lit("under a minute"))
    )
    rows = _timed(raw).withColumn("reason", reason).filter(F.col("reason").isNotNull())
    times = {"start_time": F.col("raw_start_time"), "end_time": F.col("raw_end_time")}
    return rows.withColumns(times).select(*bronze.columns, "reason")


def silver_rides(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """Typed, priced rides (R2).

    Times are parsed with ``try_cast``: a malformed time becomes NULL and the
    ride drops out with the duration filter (``rejected_rides`` shows it),
    instead of failing the whole refresh under ANSI casts.  Whole minutes are counted like
    ``TIMESTAMPDIFF(MINUTE, ...)`` (59 s is 0); rides of 0 minutes or less
    are dropped.  Revenue keeps SQL decimal typing: minutes / 60.0 is
    decimal(27,6), times the rate decimal(31,7), stored as decimal(19,4).
    """
    timed = _timed(bronze)
    rate = F.when(F.col("user_type") == "member", F.lit(MEMBER_RATE)).otherwise(F.lit(DEFAULT_RATE))
    priced = timed.filter(F.col("_minutes") > 0).withColumns(
        {
            "ride_date": F.to_date("start_time"),
            "ride_revenue": (F.col("_minutes") / F.lit(MINUTES_PER_HOUR) * rate).cast("decimal(19,4)"),
        }
    )
    return conform(priced, SILVER_RIDES)


def gold_rides(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """Daily activity per bike (R3): distinct rides, revenue, the station of
    the day's earliest start and of its latest end.

    The first/last station is the value at the extreme time even when that
    value is NULL; equal times are ordered by ride_id.  The grouping keys
    are exactly the non-aggregated columns (what ``GROUP BY ALL`` infers).
    """
    daily = silver.groupBy("ride_date", "bike_id").agg(
        F.count_distinct("ride_id").alias("total_rides"),
        F.sum("ride_revenue").cast("decimal(19,4)").alias("total_revenue"),
        F.min_by("start_station_id", F.struct("start_time", "ride_id")).alias("first_start_station_id"),
        F.max_by("end_station_id", F.struct("end_time", "ride_id")).alias("last_end_station_id"),
    )
    return conform(daily, GOLD_RIDES)


# --- stored views ---------------------------------------------------------------

SILVER_VIEW, GOLD_VIEW = "silver_bike_rides", "gold_bike_days"
VIEWS = {SILVER_VIEW: SILVER_RIDES, GOLD_VIEW: GOLD_RIDES}


def refresh_views(lake: Lake, bronze: DataFrame) -> None:
    """Create the two stored results if absent, with the declared types and
    comments, and refill them (``CREATE OR REFRESH``): the daily activity is
    computed from the stored rides."""
    for name, columns in VIEWS.items():
        lake.create(name, columns)
    lake.replace(SILVER_VIEW, silver_rides(lake.spark, bronze))
    lake.replace(GOLD_VIEW, gold_rides(lake.spark, lake.read(SILVER_VIEW)))
