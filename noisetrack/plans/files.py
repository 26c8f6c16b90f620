"""Registered queries on sources, sinks and the curated layer; each round trip has an SQL twin on the table it started from."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from noisetrack.operators import clean, gate, joins
from noisetrack.operators.cube import cube_noise
from noisetrack.plans import core, views
from noisetrack.plans.core import query
from noisetrack.plans.views import with_views
from noisetrack.schemas import STATE_FIELDS
from noisetrack.session import materialised, scratch
from noisetrack.sources import landing

_STATE_COLS = "icao24, snapshot_ts, latitude, longitude, on_ground, last_contact_unix"


@query(with_views(f"SELECT {_STATE_COLS} FROM states_raw", states=True))
def scan_states(spark, sf_dir):
    path = scratch(spark, "states")
    landing.write_states(views.states_raw(spark, sf_dir), path)
    return landing.read_states(spark, path).selectExpr(*_STATE_COLS.split(", "))


@query(with_views(f"SELECT {_STATE_COLS} FROM states_raw WHERE latitude IS NOT NULL AND NOT on_ground", states=True))
def scan_airborne(spark, sf_dir):
    path = scratch(spark, "states")
    landing.write_states(views.states_raw(spark, sf_dir), path)
    return landing.read_states(spark, path).where("latitude IS NOT NULL AND on_ground = false").selectExpr(*_STATE_COLS.split(", "))


@query(with_views("SELECT event_id, station, t, laeq_db FROM noise WHERE CAST(make_timestamp(t * 1000000) AS DATE) = DATE '2025-09-22'", noise_=True))
def scan_day_pruned(spark, sf_dir):
    path = scratch(spark, "events")
    landing.write_events(core.noise(spark, sf_dir), path)
    return landing.read_events(spark, path).where(F.col("date") == F.lit("2025-09-22").cast("date")).select("event_id", "station", "t", "laeq_db")


@query(with_views("SELECT station, count(*) AS n, round(sum(laeq_db), 4) AS total FROM noise GROUP BY station", noise_=True))
def load_noise_events(spark, sf_dir):
    path = scratch(spark, "events")
    landing.write_events(core.noise(spark, sf_dir), path)
    return landing.read_events(spark, path).groupBy("station").agg(F.count("*").alias("n"), F.round(F.sum("laeq_db"), 4).alias("total"))


@query(with_views(core.NOISE_CLEAN_SQL, more=core.NOISE_TEXT_SQL))
def scan_csv(spark, sf_dir):
    path = landing.write_csv(core.noise_text(spark, sf_dir), scratch(spark, "csv"))
    out = clean.clean_noise(landing.read_noise_csv(spark, path))
    return out.select("station_id", "airport", F.unix_micros("timestamp").alias("ts_us"), "laeq_db", "lmax_db", "latitude", "longitude", "hour", "day_of_week", "is_night", "is_rush_hour", "is_weekend")


_SNAP = "icao24, callsign, origin_country, time_position_unix, longitude, latitude, baro_altitude_m, velocity_m_s, heading_deg, squawk, last_contact_unix"


@query(with_views("SELECT icao24, callsign, time_position_unix, time_position_unix AS snapshot_ts, longitude, latitude, baro_altitude_m, velocity_m_s, false AS on_ground FROM states_raw", states=True))
def load_snapshot(spark, sf_dir):
    path = landing.write_csv(views.states_raw(spark, sf_dir).selectExpr(*_SNAP.split(", ")), scratch(spark, "csv"))
    return landing.load_snapshot(spark, path).select("icao24", "callsign", "time_position_unix", "snapshot_ts", "longitude", "latitude", "baro_altitude_m", "velocity_m_s", "on_ground")


STATES_A_PAYLOAD = 5_000


def payloads(spark, sf_dir):
    """JSON payloads (arrays of arrays of strings), as many for each snapshot time as keep them at some 5,000 aircraft."""
    s = views.states_raw(spark, sf_dir)
    of = {"icao24": F.col("icao24"), "callsign": F.concat("callsign", F.lit("  ")), "origin_country": F.col("origin_country"), "time_position": F.when(F.col("last_contact_unix") % 7 != 0, F.col("time_position_unix")), "last_contact": F.col("last_contact_unix"), "longitude": F.col("longitude"), "latitude": F.col("latitude"), "baro_altitude_m": F.col("baro_altitude_m"), "on_ground": F.col("on_ground"), "velocity_m_s": F.col("velocity_m_s"), "true_track_deg": F.col("heading_deg"), "squawk": F.col("squawk")}
    row = F.array(*[of.get(f, F.lit(None)).cast("string") for f in STATE_FIELDS])
    most = s.groupBy("snapshot_ts").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    slice_ = F.pmod(F.xxhash64("icao24", "last_contact_unix"), F.lit(max(1, -(-most // STATES_A_PAYLOAD))))
    return s.groupBy("snapshot_ts", slice_.alias("slice")).agg(F.to_json(F.struct(F.first("snapshot_ts").alias("time"), F.collect_list(row).alias("states"))).alias("value"))


@query(with_views("SELECT icao24, callsign, CASE WHEN last_contact_unix % 7 <> 0 THEN time_position_unix ELSE snapshot_ts END AS time_position_unix, last_contact_unix, longitude, latitude, baro_altitude_m, velocity_m_s, heading_deg, on_ground, snapshot_ts FROM states_raw", states=True))
def parse_states_json(spark, sf_dir):
    return landing.parse_states(payloads(spark, sf_dir)).select("icao24", "callsign", "time_position_unix", "last_contact_unix", "longitude", "latitude", "baro_altitude_m", "velocity_m_s", "heading_deg", "on_ground", "snapshot_ts")


def event_json(spark, sf_dir):
    """Event objects as text: some without valid, peak or level, some that aren't aircraft."""
    iso = views._ISO["spark"]
    return views.events(spark, sf_dir).selectExpr(
        "concat('S', cast(user_id % 6 as string)) as station",
        f"concat('{{\"id\":', cast(event_id as string), ',\"category\":\"', if(event_id % 3 = 0, 'road', 'air'), '\",\"start\":\"', {iso}, 'Z\",\"end\":\"', {iso}, '+0000\",\"max_ts\":', if(event_id % 11 = 0, 'null', concat('\"', {iso}, '+00:00\"')),"
        " ',\"max_laeq\":', if(event_id % 13 = 0, 'null', cast(event_id % 97 as string)), case when event_id % 4 = 0 then ',\"valid\":null' when event_id % 4 = 1 then ',\"valid\":true' when event_id % 4 = 2 then ',\"valid\":false' else '' end, '}') as value",
    )


@query("SELECT concat('S', CAST(user_id % 6 AS VARCHAR)) AS station, event_id, epoch(date_trunc('second', ts)) AS max_ts_unix, 0e0 AS duration_s, CAST(event_id % 97 AS DOUBLE) AS max_laeq, event_id % 4 IN (1, 3) AS valid FROM events WHERE event_id % 3 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0")
def normalize_events(spark, sf_dir):
    return landing.normalize_events(event_json(spark, sf_dir)).select("station", "event_id", "max_ts_unix", "duration_s", "max_laeq", "valid")


@query(with_views("SELECT date, snapshot_ts, count(*) AS n FROM (SELECT CAST(make_timestamp(snapshot_ts * 1000000) AS DATE)::VARCHAR AS date, snapshot_ts FROM states_raw) GROUP BY ALL", states=True))
def sink_states(spark, sf_dir):
    """Part of the rows of every other snapshot first, then all: a snapshot is replaced as a whole."""
    path, rows = scratch(spark, "states"), views.states_raw(spark, sf_dir)
    landing.write_states(rows.where("snapshot_ts % 60 = 0 AND NOT on_ground"), path)
    landing.write_states(rows, path)
    return landing.read_states(spark, path).groupBy(F.col("date").cast("string").alias("date"), "snapshot_ts").agg(F.count("*").alias("n"))


@query(with_views("SELECT station, count(*) AS n FROM noise GROUP BY station", noise_=True))
def sink_events(spark, sf_dir):
    path, rows = scratch(spark, "events"), core.noise(spark, sf_dir)
    landing.write_events(rows, path)
    landing.write_events(rows.where("station = 'S1'"), path)  # other stations stay
    return landing.read_events(spark, path).groupBy("station").agg(F.count("*").alias("n"))


@query("SELECT concat('S', CAST(user_id % 6 AS VARCHAR)) AS station, count(*) AS n FROM events GROUP BY ALL")
def sink_raw_json(spark, sf_dir):
    path = landing.write_raw_json(event_json(spark, sf_dir), scratch(spark, "json"))
    return spark.read.schema("value string, station string").json(path).groupBy("station").agg(F.count("value").alias("n"))


@query(f"SELECT batch_id, mode, snapshot_ts, rows, duration_ms, bytes_written, ok, throughput_rows_per_s FROM ({core._METRICS_SQL})")
def metrics_roundtrip(spark, sf_dir):
    path, rows = scratch(spark, "metrics"), core.metrics(spark, sf_dir)
    before = landing.read_metrics(spark, path)  # no log yet: empty
    landing.log_metrics(rows.where("ok"), path)
    landing.log_metrics(rows.where("NOT ok"), path)
    return landing.read_metrics(spark, path).unionByName(before).select("batch_id", "mode", "snapshot_ts", "rows", "duration_ms", "bytes_written", "ok", "throughput_rows_per_s")


@query(core.on_pairs("SELECT event_id, station, icao24, slant_km, n_candidates FROM pairs"))
def sink_pairs_csv(spark, sf_dir):
    df = core.pairs(spark, sf_dir)
    return spark.read.option("header", True).schema(df.schema).csv(landing.write_csv(df, scratch(spark, "pairs"))).select("event_id", "station", "icao24", "slant_km", "n_candidates")


def again(spark, report, name):
    """A report written as JSON and read."""
    return spark.read.schema(report.schema).json(landing.write_report(report, scratch(spark, name)))


_VERDICT_SQL = core.ORACLE["gate_verdict"]
_VERDICT_HEAD, _VERDICT_TAIL = _VERDICT_SQL[: _VERDICT_SQL.rindex(" SELECT *, CASE WHEN rate_pct")], _VERDICT_SQL[_VERDICT_SQL.rindex(" SELECT *, CASE WHEN rate_pct") :]
_SENSITIVITY_TAIL = core.ORACLE["gate_sensitivity"][len(core.on_gate("")) :]


@query(f"{_VERDICT_HEAD}, verdict AS ({_VERDICT_TAIL}), counts AS (SELECT status, count(*) AS n FROM gate GROUP BY status), grid AS ({_SENSITIVITY_TAIL}) SELECT 'verdict' AS part, concat_ws(' ', decision, missing) AS what, CAST(n_clean AS DOUBLE) AS n, CAST(rate_pct AS DOUBLE) AS pct FROM verdict UNION ALL SELECT 'status', status, n, round(100 * n / (SELECT sum(n) FROM counts), 1) FROM counts UNION ALL SELECT 'sensitivity', concat_ws(' ', CAST(CAST(margin_km AS INT) AS VARCHAR), CAST(CAST(max_slant_km AS INT) AS VARCHAR)), n_clean, rate_pct FROM grid")
def gate_report(spark, sf_dir):
    """The whole report of the gate (verdict, counts by status, sensitivity) as one JSON document, read back."""
    rows = materialised(core.gate_rows(spark, sf_dir), "gate")
    report = landing.one_report({"verdict": gate.gate_summary(rows), "status": gate.status_counts(rows), "sensitivity": gate.sensitivity(rows)})
    got = again(spark, report, "gate-report")
    number = lambda c: F.col(c).cast("double")
    verdict = got.select(F.explode("verdict").alias("v")).select(F.lit("verdict").alias("part"), F.concat_ws(" ", "v.decision", "v.missing").alias("what"), number("v.n_clean").alias("n"), number("v.rate_pct").alias("pct"))
    counts = got.select(F.explode("status").alias("v"), F.aggregate("status", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("all")).select(F.lit("status").alias("part"), F.col("v.status").alias("what"), number("v.n").alias("n"), F.round(100 * F.col("v.n") / F.col("all"), 1).alias("pct"))
    grid = got.select(F.explode("sensitivity").alias("v")).select(F.lit("sensitivity").alias("part"), F.concat_ws(" ", F.col("v.margin_km").cast("int").cast("string"), F.col("v.max_slant_km").cast("int").cast("string")).alias("what"), number("v.n_clean").alias("n"), number("v.rate_pct").alias("pct"))
    return verdict.unionByName(counts).unionByName(grid)


@query(f"SELECT concat('S', CAST(station AS VARCHAR)) AS station, collect_day AS day, air_events, written, ok, error, '2024-02-01T00:00:00Z' AS collected_at FROM ({core._REPORT_SQL})")
def collection_log(spark, sf_dir):
    """The collection report as JSON lines, in two collections, read back as one log."""
    path, rows = scratch(spark, "collection"), core.report(spark, sf_dir).withColumn("station", F.concat(F.lit("S"), F.col("station").cast("string")))
    before = landing.read_collection(spark, path)
    for part in (rows.where("ok"), rows.where("NOT ok")):
        landing.log_collection(part, path, F.lit("2024-02-01T00:00:00Z"))
    return landing.read_collection(spark, path).unionByName(before)


def flights(spark, sf_dir):
    iso = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw = views.view(spark, sf_dir, views.FLIGHTS_TEXT)
    return clean.clean_flights(raw.select("flight_id", "callsign", iso(F.col("first_seen_us")).alias("first_seen_iso"), iso(F.col("last_seen_us")).alias("last_seen_iso"), "avg_altitude_m"))


def curated(spark, sf_dir):
    """The five tables of the curated layer; noise and the enriched table are stored once."""
    noise, states = core.noise(spark, sf_dir), core.states(spark, sf_dir)
    enriched = materialised(joins.spatio_temporal_join(noise, states), "enriched")
    return {"states": states, "noise_measurements": noise, "flights": flights(spark, sf_dir), "noise_enriched": enriched, "cube_noise": cube_noise(enriched)}


_FLIGHTS_CTE = f"flights AS MATERIALIZED (SELECT DISTINCT flight_id, callsign, first_seen_us, last_seen_us, try_cast(avg_altitude_m AS DOUBLE) AS avg_altitude_m FROM ({views.sql(views.FLIGHTS_TEXT)}) WHERE flight_id IS NOT NULL AND (last_seen_us / 1e6 - first_seen_us / 1e6) / 60 BETWEEN 0 AND 1440)"
_COUNTS_SQL = "SELECT 'noise_measurements' AS \"table\", (SELECT count(*) FROM noise) AS rows UNION ALL SELECT 'states', (SELECT count(*) FROM states) UNION ALL SELECT 'flights', (SELECT count(*) FROM flights) UNION ALL SELECT 'noise_enriched', (SELECT count(*) FROM noise) UNION ALL SELECT 'cube_noise', (SELECT count(*) FROM (SELECT count(*) FROM noise GROUP BY CUBE(airport, is_night, is_weekend)))"


@query(with_views(_COUNTS_SQL, states=True, noise_=True, more=_FLIGHTS_CTE))
def build_curated(spark, sf_dir):
    """Saved as tables of a database twice, listed and counted from there."""
    database = f"curated_{uuid.uuid4().hex}"
    tables = curated(spark, sf_dir)
    for _ in range(2):
        names = landing.save_tables(tables, database)
    found = landing.table_counts(spark, [f"{database}.{r['name']}" for r in landing.list_tables(spark, database).collect()])
    out = materialised(found.select(F.substring_index("table", ".", -1).alias("table"), "rows"), "counts")
    assert len(names) == len(tables)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


_QUALITY = "count(*) AS rows, CAST({n} AS BIGINT) AS columns, round(coalesce(sum({nulls}), 0) / (count(*) * {n}), 4) AS null_ratio, CAST(0 AS BIGINT) AS duplicated_rows"
_N_NOISE = len(views.NOISE) + 2


@query(with_views(f"SELECT 'noise_measurements' AS source, {_QUALITY.format(n=_N_NOISE, nulls='0')} FROM noise UNION ALL SELECT 'flights', {_QUALITY.format(n=8, nulls='(avg_altitude_m IS NULL)::BIGINT')} FROM flights UNION ALL SELECT 'noise_enriched', {_QUALITY.format(n=_N_NOISE + 7, nulls='0')} FROM noise", noise_=True, more=_FLIGHTS_CTE))
def build_report(spark, sf_dir):
    """Quality of measurements, flights and the enriched table, as one JSON report, read back."""
    tables = curated(spark, sf_dir)
    quality = [clean.quality_report(tables[n], n) for n in ("noise_measurements", "flights", "noise_enriched")]
    report = landing.one_report({"quality": quality[0].unionByName(quality[1]).unionByName(quality[2])})
    return again(spark, report, "build-report").select(F.inline("quality"))


_REAL = ("hour", "day_of_week", "is_night", "is_rush_hour", "is_weekend", "num_aircraft", "num_close_aircraft", "avg_altitude_m", "min_distance_km")


@query(
    with_views(
        f"SELECT station_id, CAST(t AS BIGINT) AS t, airport, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _REAL[:5])}, count(d)::DOUBLE AS num_aircraft, count(*) FILTER (d <= 5)::DOUBLE AS num_close_aircraft, round(coalesce(avg(alt), 0), 6) AS avg_altitude_m, round(coalesce(min(d), 0), 6) AS min_distance_km, laeq_db FROM (SELECT n.*, s.d, s.alt FROM measured n LEFT JOIN (SELECT n.row, {core.G.haversine_km('n.latitude', 'n.longitude', 's.latitude', 's.longitude')} AS d, s.baro_altitude_m AS alt FROM measured n JOIN fleet s ON abs(s.time_position_unix - n.t) <= 300 WHERE {core.G.haversine_km('n.latitude', 'n.longitude', 's.latitude', 's.longitude')} <= 20) s ON s.row = n.row) GROUP BY row, station_id, t, airport, {', '.join(_REAL[:5])}, laeq_db",
        states=True,
        more="fleet AS MATERIALIZED (SELECT icao24, time_position_unix, latitude, longitude, CASE WHEN baro_altitude_m IS NOT NULL THEN greatest(baro_altitude_m, 0.0) END AS baro_altitude_m FROM (SELECT *, row_number() OVER (PARTITION BY icao24, time_position_unix ORDER BY last_contact_unix DESC NULLS LAST, latitude NULLS LAST, longitude NULLS LAST) AS rn FROM states_raw WHERE NOT on_ground) WHERE rn = 1), "
        f"raw AS MATERIALIZED ({views.sql(views.NOISE_FILE, views.ERRORS)}), measured AS MATERIALIZED (SELECT *, row_number() OVER () AS row, CAST(floor(ts_us / 1e6) AS BIGINT) AS t FROM ({core.NOISE_CLEAN_SQL}))",
    )
)
def real_features(spark, sf_dir):
    """From files to features: measurements and a snapshot of the aircraft as CSV, cleaned each, joined."""
    noise_path = landing.write_csv(views.view(spark, sf_dir, views.NOISE_FILE, views.ERRORS), scratch(spark, "noise-csv"))
    air = views.states_raw(spark, sf_dir).where("NOT on_ground").selectExpr(*_SNAP.split(", "))
    rows = landing.real_features(spark, noise_path, landing.write_csv(air, scratch(spark, "snapshot-csv")))
    return core.rounded(rows.select("station_id", F.unix_seconds("timestamp").alias("t"), "airport", *[F.col(c).cast("double").alias(c) for c in _REAL], "laeq_db"))


@query(with_views("SELECT 'noise_measurements' AS name, (SELECT count(*) FROM noise) AS rows, (SELECT count(*) FROM noise WHERE station = 'S1' AND laeq_db >= 60) AS loud UNION ALL SELECT 'flights', 0, 0", noise_=True))
def catalog_tables(spark, sf_dir):
    """The tables that a database lists, counted, and asked by SQL with named parameters; one that isn't there is empty."""
    database = f"catalog_{uuid.uuid4().hex}"
    landing.save_tables({"noise_measurements": core.noise(spark, sf_dir)}, database)
    (name,) = [r["name"] for r in landing.list_tables(spark, database).collect()]
    sql = "SELECT count(*) AS rows, count_if(station = :station AND laeq_db >= :least) AS loud FROM IDENTIFIER(:table)"
    found = materialised(landing.query(spark, sql, table=f"{database}.{name}", station="S1", least=60.0).withColumn("name", F.lit(name)), "catalog")
    missing = landing.load_table(spark, f"{database}.flights", "flight_id string").agg(F.count("*").alias("rows"), F.count("*").alias("loud")).withColumn("name", F.lit("flights"))
    missing = materialised(missing, "catalog")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found.unionByName(missing)
