"""The domain's tables, derived from the driver's ``events`` with the same arithmetic in Spark and in DuckDB.

Thirty days of events are compressed to one day, so that noise events and aircraft states meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_US = {"spark": "unix_micros(cast(ts as timestamp))", "duck": "epoch_us(ts)"}
_ISO = {"spark": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "duck": "strftime(ts, '%Y-%m-%dT%H:%M:%S')"}
_T_ISO = {"spark": "date_format(timestamp_seconds({t}), \"yyyy-MM-dd'T'HH:mm:ss\")", "duck": "strftime(make_timestamp({t} * 1000000), '%Y-%m-%dT%H:%M:%S')"}
_DAY = {"spark": "date_format(ts, 'yyyy-MM-dd')", "duck": "strftime(ts, '%Y-%m-%d')"}
_WEEKDAY = {"spark": "weekday(ts)", "duck": "(isodow(ts) - 1)"}

T = "(cast(1758540000 as bigint) + cast(floor(({us} - 1704067200000000) / 30000000e0) as bigint))"
NIGHT = "(case when hour(ts) >= 22 or hour(ts) < 6 then 1 else 0 end)"

NOISE = {
    "event_id": "event_id",
    "station": "concat('S', cast(user_id % 6 as {string}))",
    "airport": "case user_id % 3 when 0 then 'CDG' when 1 then 'ORY' else 'LBG' end",
    "st_lat": "cast(48.70 as double) + (user_id % 6) * cast(0.05 as double)",
    "st_lon": "cast(2.20 as double) + (user_id % 6) * cast(0.05 as double)",
    "laeq_db": "cast(40 as double) + least(value, cast(50 as double))",
    "t": T,
    "ts": "ts",
    "hour": "cast(hour(ts) as int)",
    "is_night": NIGHT,
    "is_weekend": "case when event_id % 7 < 2 then 1 else 0 end",
}
STATES_RAW = {
    "icao24": "cast(user_id as {string})",
    "callsign": "concat('AF', cast(user_id % 100 as {string}))",
    "origin_country": "case when user_id % 4 = 0 then 'France' else 'Germany' end",
    "time_position_unix": T,
    "last_contact_unix": T,
    "longitude": "cast(2.18 as double) + ((event_id * 104729) % 3500) / 1e4",
    "latitude": "cast(48.65 as double) + ((event_id * 7919) % 4400) / 1e4",
    "baro_altitude_m": "case when event_id % 13 = 0 then null else value * 20 - 20 end",
    "velocity_m_s": "case when event_id % 19 = 0 then null when event_id % 23 = 0 then cast(0 as double) else cast(70 + event_id % 65 as double) end",
    "heading_deg": "case when event_id % 17 = 0 then null else cast((event_id * 37) % 360 as double) end",
    "vertical_rate_m_s": "case when event_id % 5 = 0 then cast(event_id % 21 - 10 as double) end",
    "squawk": "cast(1000 + event_id % 7000 as {string})",
    "on_ground": "event_id % 11 = 0",
    "snapshot_ts": f"{T} - {T} % 30",
    "date": "{day}",
}
NOISE_TEXT = {
    "station_id": "concat('S', cast(user_id % 6 as {string}))",
    "station_name": "concat('Station ', cast(user_id % 6 as {string}))",
    "timestamp_iso": "case when event_id % 29 = 0 then 'never' else {iso} end",
    "LAeq_dB": "case when event_id % 31 = 0 then 'n/a' when event_id % 37 = 0 then '999' else cast(event_id % 97 as {string}) end",
    "Lmax_dB": "cast(event_id % 160 as {string})",
    "latitude": "case when event_id % 41 = 0 then null else cast(48 + event_id % 2 as {string}) end",
    "longitude": "cast(2 + event_id % 2 as {string})",
    "airport": "case user_id % 3 when 0 then 'CDG' when 1 then 'ORY' else 'LBG' end",
}
#: Measurements as a file has them, at the time and place where there is traffic.
NOISE_FILE = NOISE_TEXT | {
    "timestamp_iso": "case when event_id % 29 = 0 then 'never' else {t_iso} end",
    "latitude": "case when event_id % 41 = 0 then null else cast(cast(48.70 as decimal(9, 2)) + (user_id % 6) * cast(0.05 as decimal(9, 2)) as {string}) end",
    "longitude": "cast(cast(2.20 as decimal(9, 2)) + (user_id % 6) * cast(0.05 as decimal(9, 2)) as {string})",
}
FLIGHTS_TEXT = {
    "flight_id": "case when event_id % 43 = 0 then null else concat('F', cast(event_id as {string})) end",
    "callsign": "concat('AF', cast(user_id % 100 as {string}))",
    "first_seen_us": "{us}",
    "last_seen_us": "{us} + (event_id % 1600 - 60) * 60000000",
    "avg_altitude_m": "case when event_id % 47 = 0 then 'high' else cast(event_id % 12000 as {string}) end",
}
SAMPLES = {
    "station": "concat('S', cast(user_id % 6 as {string}))",
    "sample_t": T,
    "leq": "case when event_id % 9 = 0 then null else cast(40 as double) + least(value, cast(50 as double)) end",
    "azimuth": "cast((event_id * 53) % 360 as double)",
    "elevation": "cast(event_id % 90 as double)",
    "valid": "event_id % 4 <> 0",
}
METRICS = {
    "batch_id": "concat('b', cast(event_id as {string}))",
    "mode": "'replay'",
    "snapshot_ts": T,
    "rows": "event_id % 200",
    "duration_ms": "case when event_id % 50 = 0 then cast(0 as double) else cast(event_id % 997 as double) + 1 end",
    "bytes_written": "event_id % 4096",
    "ok": "event_id % 10 <> 0",
}


def _text(expression: str, engine: str) -> str:
    expression = expression.replace("{t_iso}", _T_ISO[engine].replace("{t}", T))
    return expression.format(us=_US[engine], iso=_ISO[engine], day=_DAY[engine], weekday=_WEEKDAY[engine], string={"spark": "string", "duck": "varchar"}[engine])


def _select(columns: dict[str, str], engine: str) -> list[str]:
    return [f"{_text(e, engine)} as {name}" for name, e in columns.items()]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def view(spark: SparkSession, sf_dir: str, columns: dict[str, str], where: str = "true") -> DataFrame:
    return events(spark, sf_dir).where(where).selectExpr(*_select(columns, "spark"))


def sql(columns: dict[str, str], where: str = "true") -> str:
    return f"SELECT {', '.join(_select(columns, 'duck'))} FROM events WHERE {where}"


ERRORS, OTHERS = "event_type = 'error'", "event_type <> 'error'"


def noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise measurements with station, level and time; also as events with max_laeq and max_ts_unix."""
    return view(spark, sf_dir, NOISE, ERRORS).selectExpr("*", "laeq_db as max_laeq", "cast(t as double) as max_ts_unix")


def states_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States with a tenth of the rows doubled (an earlier contact with another speed)."""
    rows = view(spark, sf_dir, STATES_RAW, OTHERS)
    again = view(spark, sf_dir, STATES_RAW, f"{OTHERS} and event_id % 10 = 0").selectExpr(*[c if c not in ("last_contact_unix", "velocity_m_s") else f"{c} - 1 as {c}" for c in rows.columns])
    return rows.unionByName(again)


NOISE_SQL = f"SELECT *, laeq_db AS max_laeq, CAST(t AS DOUBLE) AS max_ts_unix FROM ({sql(NOISE, ERRORS)})"
_again = ", ".join(c if c not in ("last_contact_unix", "velocity_m_s") else f"{c} - 1 AS {c}" for c in STATES_RAW)
STATES_RAW_SQL = f"{sql(STATES_RAW, OTHERS)} UNION ALL SELECT {_again} FROM ({sql(STATES_RAW, OTHERS + ' and event_id % 10 = 0')})"
STATES_SQL = """
SELECT icao24, callsign, origin_country, time_position_unix, last_contact_unix, longitude, latitude,
 CASE WHEN baro_altitude_m IS NOT NULL THEN greatest(baro_altitude_m, 0.0) END AS baro_altitude_m,
 CASE WHEN velocity_m_s IS NOT NULL THEN greatest(velocity_m_s, 0.0) END AS velocity_m_s,
 heading_deg, vertical_rate_m_s, squawk, on_ground, snapshot_ts, date
FROM (SELECT *, row_number() OVER (PARTITION BY icao24, snapshot_ts ORDER BY last_contact_unix DESC NULLS LAST, time_position_unix NULLS LAST, latitude NULLS LAST,
 longitude NULLS LAST, baro_altitude_m NULLS LAST, velocity_m_s NULLS LAST, heading_deg NULLS LAST) AS rn FROM states_raw
 WHERE icao24 IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND snapshot_ts IS NOT NULL)
WHERE rn = 1 AND NOT coalesce(on_ground, false)
"""


def with_views(query: str, *, states: bool = False, noise_: bool = False, more: str = "") -> str:
    """A DuckDB query with the views it needs in front."""
    parts = []
    if noise_:
        parts.append(f"noise AS MATERIALIZED ({NOISE_SQL})")
    if states:
        parts += [f"states_raw AS MATERIALIZED ({STATES_RAW_SQL})", f"states AS MATERIALIZED ({STATES_SQL})"]
    if more:
        parts.append(more)
    return f"WITH {', '.join(parts)} {query}" if parts else query
