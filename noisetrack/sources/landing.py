"""Landing zones and files: parsing, scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noisetrack.functions.times import epoch_seconds, parse_iso
from noisetrack.operators.clean import clean_noise, clean_states, numeric
from noisetrack.operators.joins import spatio_temporal_join
from noisetrack.schemas import COLLECTION, EVENT_JSON, FLIGHTS_CSV, METRICS, NOISE_CSV, NOISE_EVENTS, SNAPSHOT_CSV, STATE_FIELDS, STATES, STATES_JSON
from noisetrack.sources import zone
from noisetrack.sources.zone import exists


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A landing zone without files is an empty table of its own schema."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- JSON


def parse_states(payload: DataFrame, column: str = "value") -> DataFrame:
    """One row for each aircraft of payloads {"time", "states": [[...], ...]}; short arrays have nulls at the end, and
    null states give no rows."""
    parsed = payload.select(F.from_json(column, STATES_JSON).alias("p")).select(F.col("p.time").alias("time"), F.explode("p.states").alias("s"))
    at = {name: F.try_element_at("s", F.lit(i + 1)) for i, name in enumerate(STATE_FIELDS)}
    number = lambda name: at[name].try_cast("double")
    whole = lambda name: at[name].try_cast("double").cast("long")
    return parsed.select(
        at["icao24"].alias("icao24"),
        F.nullif(F.trim(at["callsign"]), F.lit("")).alias("callsign"),
        at["origin_country"].alias("origin_country"),
        F.coalesce(whole("time_position"), F.col("time")).alias("time_position_unix"),
        F.coalesce(whole("last_contact"), F.col("time")).alias("last_contact_unix"),
        *[number(n).alias(n) for n in ("longitude", "latitude", "baro_altitude_m", "velocity_m_s")],
        number("true_track_deg").alias("heading_deg"),
        number("vertical_rate_m_s").alias("vertical_rate_m_s"),
        at["squawk"].alias("squawk"),
        F.coalesce(at["on_ground"].try_cast("boolean"), F.lit(False)).alias("on_ground"),
        F.col("time").alias("snapshot_ts"),
    )


def normalize_events(raw: DataFrame, column: str = "value") -> DataFrame:
    """Events as JSON text (with station columns beside) as rows of the landing schema; only aircraft, and only events with
    id, peak time and peak level.  A missing ``valid`` is true, one that is null is false."""
    e = F.from_json(column, EVENT_JSON)
    peak, start, end = (parse_iso(e[c]) for c in ("max_ts", "start", "end"))
    has_valid = F.array_contains(F.json_object_keys(column), "valid")
    others = [c for c in raw.columns if c != column]
    out = raw.select(
        *others,
        e["id"].alias("event_id"),
        e["category"].alias("category"),
        epoch_seconds(start).alias("start_ts_unix"),
        epoch_seconds(end).alias("end_ts_unix"),
        epoch_seconds(peak).alias("max_ts_unix"),
        e["max_ts"].alias("max_ts_iso"),
        (epoch_seconds(end) - epoch_seconds(start)).alias("duration_s"),
        *[e[c].alias(c) for c in ("laeq", "max_laeq", "sel", "nrj_laeq")],
        F.when(has_valid, F.coalesce(e["valid"], F.lit(False))).otherwise(True).alias("valid"),
    )
    return out.where((F.col("category") == "air") & F.col("event_id").isNotNull() & F.col("max_ts_unix").isNotNull() & F.col("max_laeq").isNotNull())


# ---------------------------------------------------------------- CSV


def read_noise_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(NOISE_CSV).csv(path)


def read_flights_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(FLIGHTS_CSV).csv(path)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A fleet snapshot: numbers where they can be read, times 0 where not; icao24 stays text (some look like numbers)."""
    out = numeric(spark.read.option("header", True).schema(SNAPSHOT_CSV).csv(path), ("longitude", "latitude", "baro_altitude_m", "velocity_m_s", "heading_deg"))
    out = out.withColumns({c: F.coalesce(F.col(c).try_cast("double").cast("long"), F.lit(0)) for c in ("time_position_unix", "last_contact_unix")})
    return out.withColumns({"snapshot_ts": F.col("time_position_unix"), "on_ground": F.lit(False)})


def real_features(spark: SparkSession, noise_csv: str, snapshot_csv: str) -> DataFrame:
    """Measurements from one file enriched with the aircraft of another: both cleaned, then joined in space and time."""
    noise, states = clean_noise(read_noise_csv(spark, noise_csv)), clean_states(load_snapshot(spark, snapshot_csv))
    # Measurements have no id; equal rows are gone, so all columns together are one.
    noise = noise.withColumns({"row_id": F.xxhash64(*noise.columns), "t": F.unix_seconds("timestamp"), "st_lat": F.col("latitude"), "st_lon": F.col("longitude")})
    return spatio_temporal_join(noise, states, key="row_id").drop("row_id", "t", "st_lat", "st_lon")


# ---------------------------------------------------------------- sinks


STATES_ZONE = zone.Zone({"date": "to_date(timestamp_seconds(snapshot_ts))", "hour": "hour(timestamp_seconds(snapshot_ts))"}, "snapshot_ts long", STATES)
EVENTS_ZONE = zone.Zone({"station": "station", "date": "to_date(timestamp_seconds(max_ts_unix))"}, "station string, date date", "station string, " + NOISE_EVENTS)


def write_states(states: DataFrame, root: str) -> zone.Written:
    """States by UTC day and hour.  Writing a snapshot again replaces it and leaves the others alone."""
    return zone.write_batch(states, root, STATES_ZONE)


def read_states(spark: SparkSession, root: str) -> DataFrame:
    return zone.read(spark, root, STATES_ZONE)


def write_events(events: DataFrame, root: str) -> zone.Written:
    """Events by station and day; a (station, day) without events keeps what it had."""
    return zone.write_batch(events, root, EVENTS_ZONE)


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return zone.read(spark, root, EVENTS_ZONE)


def write_raw_json(events: DataFrame, root: str) -> str:
    """Events as they came, by station."""
    events.write.partitionBy("station").mode("append").json(root)
    return root


def log_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str = METRICS) -> DataFrame:
    """The log so far; none is an empty table."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def log_collection(report: DataFrame, path: str, at: Column) -> None:
    """A collection report (a row a station and day) as JSON lines, each with the time of the collection."""
    report.select(at.alias("collected_at"), "station", F.col("collect_day").alias("day"), "air_events", "written", "ok", "error").write.mode("append").json(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return read_metrics(spark, path, COLLECTION)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """A small result as JSON, replacing an earlier one."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def one_report(parts: dict[str, DataFrame]) -> DataFrame:
    """One nested row: for each part an array of its rows, in the order of their columns."""
    out = None
    for name, df in parts.items():
        rows = F.sort_array(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])))  # reports have few rows
        one = df.agg(rows.alias(name)).withColumn("_k", F.lit(1))
        out = one if out is None else out.join(one, "_k")
    return out.drop("_k")


def save_tables(tables: dict[str, DataFrame], database: str) -> list[str]:
    """Curated tables of a database, replaced as a whole; running it again gives the same.  Returns their full names."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:d)", args={"d": database})
    names = []
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        names.append(f"{database}.{name}")
    return names


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """name of each table; a database that isn't there has none."""
    names = [t.name for t in spark.catalog.listTables(database)] if spark.catalog.databaseExists(database) else []
    return spark.createDataFrame([(n,) for n in sorted(names)], "name string")


def load_table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A table by name, or an empty one of the schema."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def query(spark: SparkSession, sql: str, **values) -> DataFrame:
    """SQL with named parameters (:name), which are values and never text of the statement; names of tables go through
    IDENTIFIER(:name)."""
    return spark.sql(sql, args=values)


def table_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """table and rows of each; a table that isn't there is left out."""
    out = None
    for name in names:
        if spark.catalog.tableExists(name):
            one = spark.table(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
            out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "table string, rows long")
