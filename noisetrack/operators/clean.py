"""Cleaning and quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noisetrack.functions.times import epoch_seconds, parse_iso, time_features

LAEQ_MIN_DB, LAEQ_MAX_DB = 20.0, 130.0
MAX_FLIGHT_MINUTES = 24 * 60


def numeric(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Those of the columns that are there as doubles; what can't be read, and NaN, is null."""
    cast = {c: F.nullif(F.col(c).try_cast("double"), F.lit(float("nan"))) for c in columns if c in df.columns}
    return df.withColumns(cast) if cast else df


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Null stays null."""
    out = x if low is None else F.greatest(x, F.lit(low))
    out = out if high is None else F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def clean_noise(df: DataFrame) -> DataFrame:
    """Noise measurements: names, types, whole-row duplicates, rows without key values, levels into 20..130 dB (the peak
    level stays as it is), time features."""
    out = df.withColumnsRenamed({"LAeq_dB": "laeq_db", "Lmax_dB": "lmax_db"}).withColumn("timestamp", parse_iso(F.col("timestamp_iso")))
    out = numeric(out, ("laeq_db", "lmax_db", "latitude", "longitude")).dropDuplicates()
    out = out.na.drop(subset=["timestamp", "laeq_db", "latitude", "longitude"]).withColumn("laeq_db", clip(F.col("laeq_db"), LAEQ_MIN_DB, LAEQ_MAX_DB))
    return time_features(out)


def clean_states(df: DataFrame) -> DataFrame:
    """Aircraft states: one row for an aircraft and snapshot (last contact first, then the other columns in order), without
    those on the ground, altitude and speed not below zero.  As duplicates go first, a key whose first row is on the
    ground is gone."""
    out = numeric(df, ("longitude", "latitude", "baro_altitude_m", "velocity_m_s", "heading_deg"))
    out = out.withColumn("timestamp", F.timestamp_seconds("time_position_unix")).na.drop(subset=["icao24", "latitude", "longitude", "snapshot_ts"])
    rest = [F.col(c).asc_nulls_last() for c in ("time_position_unix", "latitude", "longitude", "baro_altitude_m", "velocity_m_s", "heading_deg")]
    out = first_by(out, ["icao24", "snapshot_ts"], [F.col("last_contact_unix").desc_nulls_last(), *rest])
    if "on_ground" in out.columns:
        out = out.where(~F.coalesce("on_ground", F.lit(False)))
    return out.withColumns({"baro_altitude_m": clip(F.col("baro_altitude_m"), 0.0), "velocity_m_s": clip(F.col("velocity_m_s"), 0.0)})


def clean_flights(df: DataFrame) -> DataFrame:
    """Flight history: types, duplicates, flights of 0 to 24 hours."""
    out = df.withColumns({"first_seen": parse_iso(F.col("first_seen_iso")), "last_seen": parse_iso(F.col("last_seen_iso"))})
    out = numeric(out, ("avg_altitude_m", "avg_speed_knots", "approx_distance_km")).dropDuplicates().na.drop(subset=["flight_id", "first_seen", "last_seen"])
    out = out.withColumn("duration_min", (epoch_seconds(F.col("last_seen")) - epoch_seconds(F.col("first_seen"))) / 60)
    return out.where(F.col("duration_min").between(0, MAX_FLIGHT_MINUTES))


def dedup_events(df: DataFrame, keys: tuple[str, ...] = ("station", "collect_day", "event_id")) -> DataFrame:
    """One row for an event; fetch windows may overlap."""
    return first_by(df, list(keys), [F.col(c).asc_nulls_last() for c in df.columns if c not in keys])


def quality_report(df: DataFrame, name: str) -> DataFrame:
    """source, rows, columns, null_ratio (mean over columns) and duplicated_rows, in one pass over rows grouped by all
    columns (equal rows meet before they are counted)."""
    columns = df.columns
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_n"))
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("long") for c in columns])
    return grouped.agg(
        F.lit(name).alias("source"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.lit(len(columns)).cast("long").alias("columns"),
        F.round(F.try_divide(F.sum(nulls * F.col("_n")), F.sum("_n") * len(columns)), 4).alias("null_ratio"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("duplicated_rows"),
    )
