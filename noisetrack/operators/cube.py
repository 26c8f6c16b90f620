"""The noise cube, levels, dashboards' figures and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.functions.acoustic import SOURCE_HEAVY_DB, SOURCE_LIGHT_DB, energy, energy_sum_db, received_db
from noisetrack.functions.geo import haversine_km, slant_km
from noisetrack.functions.stats import quantiles
from noisetrack.operators.joins import bin_of, bins_around, interval_join, shared

DIMENSIONS = ("airport", "is_night", "is_weekend")


def cube_noise(enriched: DataFrame, labelled: bool = False) -> DataFrame:
    """Counts and levels for all combinations of airport, period and kind of day.

    Sub-totals over period or kind of day read 'jour' and 'semaine', told apart by ``niveau_agregation`` only; with
    ``labelled`` they read 'TOUS', and an airport that is really null stays null.
    """
    measures = [
        F.count("*").alias("n_mesures"),
        F.round(F.avg("laeq_db"), 2).alias("laeq_moyen_db"),
        F.round(F.max("laeq_db"), 2).alias("laeq_max_db"),
        F.round(F.avg("num_aircraft"), 2).alias("avions_moyen"),
    ]
    marks = [F.grouping(d).cast("int").alias(f"_{d}") for d in DIMENSIONS]
    out = enriched.cube(*DIMENSIONS).agg(F.grouping_id().cast("long").alias("niveau_agregation"), *marks, *measures)
    period = F.when(F.col("is_night") == 1, "nuit").otherwise("jour")
    kind = F.when(F.col("is_weekend") == 1, "we").otherwise("semaine")
    airport = F.coalesce("airport", F.lit("TOUS"))
    if labelled:
        airport = F.when(F.col("_airport") == 1, "TOUS").otherwise(F.col("airport"))
        period = F.when(F.col("_is_night") == 1, "TOUS").otherwise(period)
        kind = F.when(F.col("_is_weekend") == 1, "TOUS").otherwise(kind)
    return out.select(airport.alias("airport"), period.alias("periode"), kind.alias("type_jour"), "niveau_agregation", "n_mesures", "laeq_moyen_db", "laeq_max_db", "avions_moyen")


HLL_BITS = 12
#: The relative standard error of a count with 2 ** 12 registers is 1.6 %; five times that is never exceeded in practice.
DISTINCT_ERROR = 0.08


def distinct_parts(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """A mergeable (HyperLogLog) sketch of a column's distinct values for each finest combination: what is stored a day."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(column), HLL_BITS).alias("sketch"))


def distinct_cube(parts: DataFrame, by: list[str]) -> DataFrame:
    """Distinct counts for all combinations, totals included, rolled up from the parts and not from rows.  level: the
    grouping id."""
    return parts.cube(*by).agg(F.grouping_id().cast("long").alias("level"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def physics_level(pairs: DataFrame, heavy_above_m: float = 8000.0) -> DataFrame:
    """event_id, estimated level (sources and ambient added as energies) and highest single level, from pairs (event_id,
    slant_m, altitude_m, ambient_db)."""
    source = F.when(F.col("altitude_m") > heavy_above_m, SOURCE_HEAVY_DB).otherwise(SOURCE_LIGHT_DB)
    level = received_db(source, F.col("slant_m"))
    return pairs.withColumn("_level", level).groupBy("event_id", "ambient_db").agg(energy_sum_db(F.col("_level"), F.col("ambient_db")).alias("level_db"), F.max("_level").alias("max_level_db")).drop("ambient_db")


def physics_level_of(events: DataFrame, states: DataFrame, tol: float, heavy_above_m: float = 8000.0) -> DataFrame:
    """``physics_level`` of events (event_id, st_lat, st_lon, t, ambient_db) and the states (snapshot_ts, latitude, longitude,
    altitude_m) within ``tol`` seconds.  Where events share places (stations), what a place hears of a snapshot is added up once."""
    slant = lambda df: df.withColumn("slant_m", 1000 * slant_km(haversine_km(F.col("st_lat"), F.col("st_lon"), F.col("latitude"), F.col("longitude")), F.col("altitude_m")))
    binned = events.withColumn("_bin", bins_around(F.col("t"), tol))
    if not shared(binned, "_bin", "st_lat", "st_lon"):
        return physics_level(slant(interval_join(events, states, "t", "snapshot_ts", tol)).select("event_id", "slant_m", "altitude_m", "ambient_db"), heavy_above_m)
    level = received_db(F.when(F.col("altitude_m") > heavy_above_m, SOURCE_HEAVY_DB).otherwise(SOURCE_LIGHT_DB), F.col("slant_m"))
    heard = slant(binned.select("_bin", "st_lat", "st_lon").distinct().join(states.withColumn("_bin", bin_of(F.col("snapshot_ts"), 2 * tol)), "_bin")).withColumn("_level", level)
    heard = heard.groupBy("_bin", "st_lat", "st_lon", "snapshot_ts").agg(F.sum(energy(F.col("_level"))).alias("_energy"), F.max("_level").alias("_max"))
    a, b = binned.alias("a"), heard.alias("b")
    same = (F.col("a._bin") == F.col("b._bin")) & F.col("a.st_lat").eqNullSafe(F.col("b.st_lat")) & F.col("a.st_lon").eqNullSafe(F.col("b.st_lon"))
    met = a.join(b, same).where(F.abs(F.col("snapshot_ts") - F.col("t")) <= tol).groupBy("event_id", "ambient_db").agg(F.sum("_energy").alias("_energy"), F.max("_max").alias("max_level_db"))
    total = F.coalesce("_energy", F.lit(0.0)) + energy(F.col("ambient_db"))
    return met.select("event_id", (10 * F.log10(total)).alias("level_db"), "max_level_db")


def throughput(rows, duration_ms):
    """Rows a second, 0 where no time was taken."""
    return F.when(duration_ms <= 0, 0.0).otherwise(F.round(rows / (duration_ms / 1000), 1))


def monitoring_summary(metrics: DataFrame) -> DataFrame:
    """Batches, rows, latencies (the median is the upper one), throughput and bytes."""
    one = metrics.agg(
        F.count("*").alias("batches"),
        F.count_if("ok").alias("batches_ok"),
        F.sum("rows").alias("rows_total"),
        F.round(F.max("duration_ms"), 1).alias("latency_ms_max"),
        F.round(F.avg("throughput_rows_per_s"), 1).alias("throughput_rows_per_s_avg"),
        F.sum("bytes_written").alias("bytes_total"),
    )
    median = quantiles(metrics, "duration_ms", [], {"m": 0.5}, interpolate=False).select(F.round("m", 1).alias("latency_ms_p50"), F.lit(1).alias("_k"))
    return one.withColumn("_k", F.lit(1)).join(median, "_k", "left").drop("_k")


def cycle_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count("*").alias("batches"), F.count_if("ok").alias("batches_ok"), F.sum("rows").alias("rows_ingested"), F.round(F.sum("duration_ms") / 1000, 2).alias("cycle_seconds"))


def collect_report(attempts: DataFrame, events: DataFrame) -> DataFrame:
    """Per station and day that was asked for: fetched and written (distinct) events, ``ok`` and the error of a failed one,
    which writes nothing.

    attempts: station, collect_day, error (null where all went well), several rows a station and day if windows are fetched
    one by one; a day without events is in the report too."""
    asked = attempts.groupBy("station", "collect_day").agg(F.max("error").alias("error"))
    counts = events.groupBy("station", "collect_day").agg(F.count("*").alias("air_events"), F.countDistinct("event_id").alias("distinct"))
    ok, found = F.col("error").isNull(), asked.join(counts, ["station", "collect_day"], "left")
    return found.select("station", "collect_day", F.coalesce("air_events", F.lit(0)).alias("air_events"), F.when(ok, F.coalesce("distinct", F.lit(0))).otherwise(0).alias("written"), ok.alias("ok"), "error")


def collect_summary(report: DataFrame) -> DataFrame:
    """One row: station-days, those that went well, events fetched and written."""
    return report.agg(F.count("*").alias("station_days"), F.count_if("ok").alias("station_days_ok"), F.coalesce(F.sum("air_events"), F.lit(0)).alias("air_events_total"), F.coalesce(F.sum("written"), F.lit(0)).alias("written_total"))
