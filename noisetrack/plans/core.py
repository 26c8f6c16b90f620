"""Registered queries on cleaning, joins, cube and validation, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noisetrack.functions import acoustic, geo, stats, times
from noisetrack.ml.features import training_frame as frame
from noisetrack.operators import clean, cube, gate, joins
from noisetrack.plans import geo_sql as G
from noisetrack.plans import views
from noisetrack.plans.views import with_views
from noisetrack.schemas import AIRCRAFT_FEATURES, BOX, STATIONS, empty_states, stations
from noisetrack.session import materialised

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_states(views.states_raw(spark, sf_dir)).drop("timestamp")


def noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.noise(spark, sf_dir)


# ---------------------------------------------------------------- cleaning

_TS = "try_cast(nullif(trim(timestamp_iso), '') AS TIMESTAMP)"
NOISE_CLEAN_SQL = f"""
SELECT station_id, airport, epoch_us(ts) AS ts_us, least(greatest(l, 20.0), 130.0) AS laeq_db, m AS lmax_db, la AS latitude, lo AS longitude,
 CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week, CASE WHEN hour(ts) >= 22 OR hour(ts) < 6 THEN 1 ELSE 0 END AS is_night,
 CASE WHEN hour(ts) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT DISTINCT *, {_TS} AS ts, try_cast(LAeq_dB AS DOUBLE) AS l, try_cast(Lmax_dB AS DOUBLE) AS m, try_cast(latitude AS DOUBLE) AS la, try_cast(longitude AS DOUBLE) AS lo FROM raw)
WHERE ts IS NOT NULL AND l IS NOT NULL AND la IS NOT NULL AND lo IS NOT NULL
"""
NOISE_TEXT_SQL = f"raw AS MATERIALIZED ({views.sql(views.NOISE_TEXT)} UNION ALL {views.sql(views.NOISE_TEXT, 'event_id % 10 = 0')})"


def noise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.NOISE_TEXT).unionByName(views.view(spark, sf_dir, views.NOISE_TEXT, "event_id % 10 = 0"))


@query(with_views(NOISE_CLEAN_SQL, more=NOISE_TEXT_SQL))
def clean_noise(spark, sf_dir):
    out = clean.clean_noise(noise_text(spark, sf_dir))
    return out.select("station_id", "airport", F.unix_micros("timestamp").alias("ts_us"), "laeq_db", "lmax_db", "latitude", "longitude", "hour", "day_of_week", "is_night", "is_rush_hour", "is_weekend")


@query(with_views("SELECT icao24, snapshot_ts, latitude, longitude, baro_altitude_m, velocity_m_s, heading_deg, last_contact_unix FROM states", states=True))
def clean_states(spark, sf_dir):
    return states(spark, sf_dir).select("icao24", "snapshot_ts", "latitude", "longitude", "baro_altitude_m", "velocity_m_s", "heading_deg", "last_contact_unix")


@query(
    f"SELECT DISTINCT flight_id, callsign, first_seen_us, last_seen_us, try_cast(avg_altitude_m AS DOUBLE) AS avg_altitude_m, (last_seen_us / 1e6 - first_seen_us / 1e6) / 60 AS duration_min"
    f" FROM ({views.sql(views.FLIGHTS_TEXT)}) WHERE flight_id IS NOT NULL AND (last_seen_us / 1e6 - first_seen_us / 1e6) / 60 BETWEEN 0 AND 1440"
)
def clean_flights(spark, sf_dir):
    raw = views.view(spark, sf_dir, views.FLIGHTS_TEXT)
    raw = raw.unionByName(views.view(spark, sf_dir, views.FLIGHTS_TEXT, "event_id % 10 = 0"))
    iso = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw = raw.select("flight_id", "callsign", iso(F.col("first_seen_us")).alias("first_seen_iso"), iso(F.col("last_seen_us")).alias("last_seen_iso"), "avg_altitude_m")
    out = clean.clean_flights(raw)
    return out.select("flight_id", "callsign", F.unix_micros("first_seen").alias("first_seen_us"), F.unix_micros("last_seen").alias("last_seen_us"), "avg_altitude_m", "duration_min")


@query(with_views("SELECT icao24, snapshot_ts, count(*) AS n FROM states GROUP BY ALL", states=True))
def dedup_states(spark, sf_dir):
    return states(spark, sf_dir).groupBy("icao24", "snapshot_ts").agg(F.count("*").alias("n"))


_FETCH_A = "SELECT user_id % 6 AS station, event_id, strftime(ts, '%Y-%m-%d') AS collect_day, round(value, 2) AS max_laeq FROM events WHERE hour(ts) <= 12"
_FETCH_B = _FETCH_A.replace("hour(ts) <= 12", "hour(ts) >= 12")


def fetches(spark, sf_dir):
    """Two adjacent fetch windows that overlap in one hour."""
    rows = views.events(spark, sf_dir).selectExpr("user_id % 6 as station", "event_id", "date_format(ts, 'yyyy-MM-dd') as collect_day", "round(value, 2) as max_laeq", "hour(ts) as h")
    return rows.where("h <= 12").drop("h").unionByName(rows.where("h >= 12").drop("h"))


@query(f"SELECT station, collect_day, count(*) AS n FROM ({_FETCH_A} UNION ALL {_FETCH_B}) GROUP BY ALL")
def union_windows(spark, sf_dir):
    return fetches(spark, sf_dir).groupBy("station", "collect_day").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT station, collect_day, event_id, max_laeq FROM ({_FETCH_A} UNION ALL {_FETCH_B})")
def dedup_events(spark, sf_dir):
    return clean.dedup_events(fetches(spark, sf_dir)).select("station", "collect_day", "event_id", "max_laeq")


_COLS = list(views.NOISE_TEXT)
_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in _COLS)


@query(with_views(f"SELECT 'noise' AS source, count(*) AS rows, CAST({len(_COLS)} AS BIGINT) AS columns, round(sum({_NULLS}) / (count(*) * {len(_COLS)}), 4) AS null_ratio, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicated_rows FROM raw", more=NOISE_TEXT_SQL))
def quality_report(spark, sf_dir):
    return clean.quality_report(noise_text(spark, sf_dir), "noise")


# ---------------------------------------------------------------- projections and functions


@query(with_views(f"SELECT icao24, snapshot_ts, latitude BETWEEN 48.70 AND 49.00 AND longitude BETWEEN 2.20 AND 2.50 AS inside FROM states WHERE latitude BETWEEN {BOX[0]} AND {BOX[2]} AND longitude BETWEEN {BOX[1]} AND {BOX[3]}", states=True))
def bbox_filter(spark, sf_dir):
    lat, lon = F.col("latitude"), F.col("longitude")
    return states(spark, sf_dir).where(geo.in_box(lat, lon, *BOX)).select("icao24", "snapshot_ts", geo.in_box(lat, lon, 48.70, 2.20, 49.00, 2.50).alias("inside"))


@query(with_views("SELECT event_id, CASE WHEN laeq_db < 50 THEN 'quiet' WHEN laeq_db < 60 THEN 'moderate' WHEN laeq_db < 68 THEN 'loud' ELSE 'very loud' END AS band FROM noise", noise_=True))
def noise_band(spark, sf_dir):
    return noise(spark, sf_dir).select("event_id", acoustic.noise_band(F.col("laeq_db")).alias("band"))


_P = ("lat", "lon", "lat2", "lon2")
_GEO_SQL = "SELECT event_id, cast(48.65 as double) + ((event_id * 7919) % 4400) / 1e4 AS lat, cast(2.18 as double) + ((event_id * 104729) % 3500) / 1e4 AS lon, cast(48.70 as double) + (user_id % 6) * cast(0.05 as double) AS lat2, cast(2.20 as double) + (user_id % 6) * cast(0.05 as double) AS lon2, value * 20 AS alt, CAST((event_id * 37) % 360 AS DOUBLE) AS hdg FROM events"


def geo_points(spark, sf_dir):
    return views.events(spark, sf_dir).selectExpr("event_id", "cast(48.65 as double) + ((event_id * 7919) % 4400) / 1e4 as lat", "cast(2.18 as double) + ((event_id * 104729) % 3500) / 1e4 as lon", "cast(48.70 as double) + (user_id % 6) * cast(0.05 as double) as lat2", "cast(2.20 as double) + (user_id % 6) * cast(0.05 as double) as lon2", "value * 20 as alt", "cast((event_id * 37) % 360 as double) as hdg")


@query(f"SELECT event_id, round({G.haversine_km(*_P)}, 6) AS km, round({G.haversine_km(*_P)} * 1000, 3) AS m, round({G.bearing(*_P)}, 6) AS bearing, round({G.ang_diff('hdg', G.bearing(*_P))}, 6) AS diff, round({G.slant_km(G.haversine_km(*_P), 'alt')}, 6) AS slant, round(degrees(atan2(alt, greatest({G.haversine_km(*_P)} * 1000, 1.0))), 6) AS elevation FROM ({_GEO_SQL})")
def geo_functions(spark, sf_dir):
    p = [F.col(c) for c in _P]
    km, m, bearing = geo.haversine_km(*p), geo.haversine_m(*p), geo.bearing_deg(*p)
    return geo_points(spark, sf_dir).select("event_id", F.round(km, 6).alias("km"), F.round(m, 3).alias("m"), F.round(bearing, 6).alias("bearing"), F.round(geo.ang_diff(F.col("hdg"), bearing), 6).alias("diff"), F.round(geo.slant_km(km, F.col("alt")), 6).alias("slant"), F.round(geo.elevation_deg(m, F.col("alt")), 6).alias("elevation"))


_A, _M = G.advance("lat", "lon", "hdg", "alt"), G.move("lat", "lon", "hdg", "alt")


@query(f"SELECT event_id, round({_A[0]}, 6) AS lat_sphere, round({_A[1]}, 6) AS lon_sphere, round({_M[0]}, 6) AS lat_plane, round({_M[1]}, 6) AS lon_plane FROM ({_GEO_SQL})")
def dead_reckon(spark, sf_dir):
    p = [F.col(c) for c in ("lat", "lon", "hdg", "alt")]
    (a, b), (c, d) = geo.advance(*p), geo.move(*p)
    return geo_points(spark, sf_dir).select("event_id", *[F.round(x, 6).alias(n) for x, n in ((a, "lat_sphere"), (b, "lon_sphere"), (c, "lat_plane"), (d, "lon_plane"))])


_X = G.advance("latitude", "longitude", "heading_deg", "coalesce(velocity_m_s, 0.0) * (next_ts - snapshot_ts)")


@query(with_views(f"SELECT icao24, snapshot_ts, next_ts, round(la, 6) AS latitude, round(lo, 6) AS longitude, round({G.haversine_km('la', 'lo', 'next_lat', 'next_lon')}, 6) AS off_km FROM (SELECT *, CASE WHEN heading_deg IS NULL THEN latitude ELSE {_X[0]} END AS la, CASE WHEN heading_deg IS NULL THEN longitude ELSE {_X[1]} END AS lo FROM (SELECT *, lead(snapshot_ts) OVER w AS next_ts, lead(latitude) OVER w AS next_lat, lead(longitude) OVER w AS next_lon FROM states WINDOW w AS (PARTITION BY icao24 ORDER BY snapshot_ts))) WHERE next_ts IS NOT NULL", states=True))
def extrapolate_positions(spark, sf_dir):
    """Each state carried on to its aircraft's next snapshot, and how far that is from where it was seen then."""
    w = Window.partitionBy("icao24").orderBy("snapshot_ts")
    rows = states(spark, sf_dir).withColumns({"next_ts": F.lead("snapshot_ts").over(w), "next_lat": F.lead("latitude").over(w), "next_lon": F.lead("longitude").over(w)}).where("next_ts IS NOT NULL")
    lat, lon = geo.advance(F.col("latitude"), F.col("longitude"), F.col("heading_deg"), F.coalesce("velocity_m_s", F.lit(0.0)) * (F.col("next_ts") - F.col("snapshot_ts")))
    still = F.col("heading_deg").isNull()
    rows = rows.withColumns({"latitude": F.when(still, F.col("latitude")).otherwise(lat), "longitude": F.when(still, F.col("longitude")).otherwise(lon)})
    off = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("next_lat"), F.col("next_lon"))
    return rounded(rows.select("icao24", "snapshot_ts", "next_ts", "latitude", "longitude", off.alias("off_km")))


@query("SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week, CASE WHEN hour(ts) >= 22 OR hour(ts) < 6 THEN 1 ELSE 0 END AS is_night, CASE WHEN hour(ts) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events")
def time_features(spark, sf_dir):
    rows = views.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    return times.time_features(rows).drop("timestamp")


_FORMS = "case event_id % 5 when 0 then concat({iso}, 'Z') when 1 then concat({iso}, '+0000') when 2 then concat({iso}, '+01:00') when 3 then {iso} else 'soon' end"


@query("SELECT event_id, CAST(CASE event_id % 5 WHEN 4 THEN NULL WHEN 2 THEN epoch_us(date_trunc('second', ts)) - 3600000000 ELSE epoch_us(date_trunc('second', ts)) END AS DOUBLE) AS us FROM events")
def parse_iso(spark, sf_dir):
    rows = views.events(spark, sf_dir).selectExpr("event_id", f"{_FORMS.format(iso=views._ISO['spark'])} as text")
    return rows.select("event_id", F.unix_micros(times.parse_iso(F.col("text"))).cast("double").alias("us"))


@query("WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), w AS (SELECT day, unnest(generate_series(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS start FROM d), c AS (SELECT CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY ALL) SELECT epoch(w.start)::BIGINT AS start_s, epoch(w.start)::BIGINT + 3600 AS stop_s, coalesce(c.n, 0) AS n FROM w LEFT JOIN c USING (day, start) WHERE w.start < TIMESTAMP '2024-01-29 12:00:00'")
def day_windows(spark, sf_dir):
    rows = views.events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"))
    days = rows.select(F.to_date("ts").alias("day")).distinct()
    now = F.lit("2024-01-29 12:00:00").cast("timestamp")
    windows = days.select(F.explode(times.windows_of_day(F.col("day"), 60, now)).alias("w")).select(F.col("w.start").alias("start"), F.col("w.stop").alias("stop"))
    counts = rows.groupBy(F.window("ts", "60 minutes").start.alias("start")).agg(F.count("*").alias("n"))
    return windows.join(counts, "start", "left").select(F.unix_seconds("start").alias("start_s"), F.unix_seconds("stop").alias("stop_s"), F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT page_id, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def regex_extract(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query(with_views("SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start_s, station, count(*) AS n, round(avg(laeq_db), 6) AS mean_db FROM noise GROUP BY ALL", noise_=True))
def tumbling_counts(spark, sf_dir):
    rows = noise(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy(F.window("ts", "60 minutes").alias("w"), "station").agg(F.count("*").alias("n"), F.round(F.avg("laeq_db"), 6).alias("mean_db")).select(F.unix_seconds("w.start").alias("start_s"), "station", "n", "mean_db")


# ---------------------------------------------------------------- joins

FEATURES_SQL = f"""
SELECT n.event_id, coalesce(count(s.icao24), 0) AS num_aircraft, count(*) FILTER (d <= 5) AS num_close_aircraft, coalesce(avg(s.baro_altitude_m), 0.0) AS avg_altitude_m,
 coalesce(min(s.baro_altitude_m), 0.0) AS min_altitude_m, coalesce(avg(s.velocity_m_s), 0.0) AS avg_velocity_m_s, coalesce(min(d), 0.0) AS min_distance_km, coalesce(avg(d), 0.0) AS avg_distance_km
FROM noise n LEFT JOIN (SELECT n.event_id, s.*, {G.haversine_km('n.st_lat', 'n.st_lon', 's.latitude', 's.longitude')} AS d FROM noise n JOIN states s ON abs(s.time_position_unix - n.t) <= 300
 WHERE {G.haversine_km('n.st_lat', 'n.st_lon', 's.latitude', 's.longitude')} <= 20) s ON s.event_id = n.event_id GROUP BY n.event_id
"""
_FEATURES = ("event_id", *AIRCRAFT_FEATURES)
_ROUND = lambda names: ", ".join(f"round({c}, 6) AS {c}" if c.startswith(("avg", "min")) else c for c in names)


@query(with_views(f"SELECT {_ROUND(_FEATURES)} FROM ({FEATURES_SQL})", states=True, noise_=True))
def spatio_temporal_join(spark, sf_dir):
    return rounded(joins.spatio_temporal_join(noise(spark, sf_dir), states(spark, sf_dir)).select(*_FEATURES))


@query(with_views("SELECT event_id, CAST(0 AS BIGINT) AS num_aircraft, CAST(0 AS BIGINT) AS num_close_aircraft, 0e0 AS avg_altitude_m, 0e0 AS min_altitude_m, 0e0 AS avg_velocity_m_s, 0e0 AS min_distance_km, 0e0 AS avg_distance_km FROM noise", noise_=True))
def empty_states_join(spark, sf_dir):
    return joins.spatio_temporal_join(noise(spark, sf_dir), clean.clean_states(empty_states(spark))).select(*_FEATURES)


@query(with_views("SELECT event_id, icao24, snapshot_ts FROM noise n JOIN states s ON abs(s.snapshot_ts - n.t) <= 45", states=True, noise_=True))
def interval_join(spark, sf_dir):
    return joins.interval_pairs(noise(spark, sf_dir).select("event_id", "t"), states(spark, sf_dir).select("icao24", "snapshot_ts"), "t", "snapshot_ts", 45).select("event_id", "icao24", "snapshot_ts")


@query(with_views("SELECT event_id, icao24, CAST(max(snapshot_ts) FILTER (snapshot_ts <= t) AS DOUBLE) AS before_ts, CAST(min(snapshot_ts) FILTER (snapshot_ts >= t) AS DOUBLE) AS after_ts FROM noise n JOIN states s ON abs(s.snapshot_ts - n.t) <= 45 GROUP BY ALL", states=True, noise_=True))
def asof_bracket(spark, sf_dir):
    found = joins.candidates(joins.asking_together(noise(spark, sf_dir)), states(spark, sf_dir), 45.0, keep=("_asking",), lists=True)
    own, exact = F.col("s.snapshot_ts").cast("double"), F.col("s.snapshot_ts") == F.col("_t")
    bracket = found.select("_asking", "icao24", F.when(~F.col("later"), own).alias("before_ts"), F.when(F.col("later") | exact, own).otherwise(F.col("z.snapshot_ts").cast("double")).alias("after_ts"))
    return joins.each_asker(bracket).select("event_id", "icao24", "before_ts", "after_ts")


def _candidates_sql(states_: str, tol: int) -> str:
    cols = ("latitude", "longitude", "baro_altitude_m", "velocity_m_s", "heading_deg", "vertical_rate_m_s", "callsign", "snapshot_ts")
    pack = "{" + ", ".join(f"'{c}': s.{c}" for c in cols) + "}"
    return f"""SELECT n.event_id, s.icao24, CAST(n.t AS DOUBLE) AS t, arg_max({pack}, s.snapshot_ts) FILTER (s.snapshot_ts <= n.t) AS b, arg_min({pack}, s.snapshot_ts) FILTER (s.snapshot_ts >= n.t) AS a,
 arg_min({pack}, abs(s.snapshot_ts - n.t) * 1e11 + s.snapshot_ts) AS n, arg_max(s.callsign, s.snapshot_ts) AS last_callsign FROM noise n JOIN {states_} s ON abs(s.snapshot_ts - n.t) <= {tol} GROUP BY ALL"""


_D = G.advance("o.latitude", "o.longitude", "o.heading_deg", "o.velocity_m_s * (t - o.snapshot_ts)")
_BOTH = "(b IS NOT NULL AND a IS NOT NULL)"
_F = "(CASE WHEN a.snapshot_ts = b.snapshot_ts THEN 0.0 ELSE (t - b.snapshot_ts) / (a.snapshot_ts - b.snapshot_ts) END)"
_MOVES = "(o.heading_deg IS NOT NULL AND (o.velocity_m_s IS NULL OR o.velocity_m_s <> 0))"


def _lerp(c: str) -> str:
    return f"(b.{c} + {_F} * (a.{c} - b.{c}))"


PLACED_SQL = f"""
SELECT c.*, CASE WHEN {_BOTH} THEN {_lerp('latitude')} WHEN {_MOVES} THEN {_D[0]} ELSE o.latitude END AS lat, CASE WHEN {_BOTH} THEN {_lerp('longitude')} WHEN {_MOVES} THEN {_D[1]} ELSE o.longitude END AS lon,
 coalesce(CASE WHEN {_BOTH} THEN CASE WHEN b.baro_altitude_m IS NULL THEN a.baro_altitude_m WHEN a.baro_altitude_m IS NULL THEN b.baro_altitude_m ELSE {_lerp('baro_altitude_m')} END
 ELSE o.baro_altitude_m + coalesce(o.vertical_rate_m_s * (t - o.snapshot_ts), 0.0) END, 0.0) AS alt, {_BOTH} AS bracketed FROM (SELECT *, coalesce(b, a) AS o FROM ({_candidates_sql('states', 45)})) c
"""


@query(with_views(f"SELECT event_id, icao24, round(lat, 6) AS lat, round(lon, 6) AS lon, round(alt, 6) AS alt, bracketed FROM ({PLACED_SQL})", states=True, noise_=True))
def estimate_position(spark, sf_dir):
    found = joins.candidates(joins.asking_together(noise(spark, sf_dir)), states(spark, sf_dir), 45.0, keep=("_asking",), lists=True)
    placed = rounded(joins.estimate_position(found).select("_asking", "icao24", "lat", "lon", "alt", "bracketed"))
    return joins.each_asker(placed).select("event_id", "icao24", "lat", "lon", "alt", "bracketed")


_H = G.haversine_km("n.st_lat", "n.st_lon", "p.lat", "p.lon")
PAIRS_SQL = f"""
SELECT n.event_id, n.station, n.max_laeq, n.max_ts_unix, x.icao24, x.callsign, round(x.slant, 3) AS slant_km, round(x.horiz, 3) AS horiz_km, round(x.alt, 1) AS altitude_m, x.vel AS velocity_m_s, x.hdg AS heading_deg,
 round(x.lat, 5) AS aircraft_lat, round(x.lon, 5) AS aircraft_lon, coalesce(k.n, 0) AS n_candidates, round(x.dt, 1) AS dt_nearest_s, n.st_lat, n.st_lon
FROM noise n LEFT JOIN (SELECT event_id, count(*) AS n FROM placed GROUP BY event_id) k ON k.event_id = n.event_id
LEFT JOIN (SELECT p.event_id, p.icao24, p.n.callsign AS callsign, {G.slant_km(_H, 'p.alt')} AS slant, {_H} AS horiz, p.alt, p.n.velocity_m_s AS vel, p.n.heading_deg AS hdg, p.lat, p.lon, p.n.snapshot_ts - p.t AS dt
 FROM placed p JOIN noise n ON n.event_id = p.event_id WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY slant, p.icao24) = 1) x ON x.event_id = n.event_id
"""
PAIRS_CTE = f"placed AS MATERIALIZED ({PLACED_SQL}), pairs AS MATERIALIZED ({PAIRS_SQL})"


def on_pairs(sql: str) -> str:
    return with_views(sql, states=True, noise_=True, more=PAIRS_CTE)


def pairs(spark, sf_dir):
    return joins.build_pairs(noise(spark, sf_dir), states(spark, sf_dir))


@query(on_pairs("SELECT event_id, station, max_laeq, max_ts_unix, icao24, callsign, slant_km, horiz_km, altitude_m, velocity_m_s, heading_deg, aircraft_lat, aircraft_lon, n_candidates, dt_nearest_s FROM pairs"))
def build_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


@query(on_pairs("SELECT event_id, icao24, slant_km, n_candidates FROM pairs"))
def associate_nearest(spark, sf_dir):
    return pairs(spark, sf_dir).select("event_id", "icao24", "slant_km", "n_candidates")


@query(on_pairs("SELECT event_id, count(DISTINCT icao24) AS n_candidates FROM placed GROUP BY event_id"))
def n_candidates(spark, sf_dir):
    return joins.candidate_counts(noise(spark, sf_dir), states(spark, sf_dir), 45.0).select("event_id", F.col("n").alias("n_candidates"))


@query(with_views("SELECT n.event_id, CAST(g.s AS DOUBLE) AS snapshot_ts, g.d AS gap_s FROM noise n LEFT JOIN (SELECT event_id, arg_min(snapshot_ts, abs(snapshot_ts - max_ts_unix) * 1e11 + snapshot_ts) AS s, min(abs(snapshot_ts - max_ts_unix)) AS d FROM noise n JOIN (SELECT DISTINCT snapshot_ts FROM states) ON abs(snapshot_ts - max_ts_unix) <= 10 GROUP BY event_id) g ON g.event_id = n.event_id", states=True, noise_=True))
def asof_nearest(spark, sf_dir):
    return joins.asof_nearest(noise(spark, sf_dir), states(spark, sf_dir), 10.0).select("event_id", F.col("snapshot_ts").cast("double").alias("snapshot_ts"), "gap_s")


@query(with_views("SELECT event_id, max_ts_unix FROM noise WHERE max_ts_unix BETWEEN (SELECT min(snapshot_ts) + 36000 FROM states) AND (SELECT max(snapshot_ts) FROM states)", states=True, noise_=True))
def events_in_window(spark, sf_dir):
    # A part of the states, so that the window leaves events out.
    rows = states(spark, sf_dir)
    low = rows.agg(F.min("snapshot_ts") + 36000).scalar()
    bound = rows.select(F.greatest(F.col("snapshot_ts"), low).alias("snapshot_ts"))
    return joins.events_in_window(noise(spark, sf_dir), bound).select("event_id", "max_ts_unix")


@query(with_views("SELECT event_id, EXISTS (SELECT 1 FROM (SELECT DISTINCT snapshot_ts FROM states) s WHERE abs(s.snapshot_ts - n.t) <= 5) AS has_snapshot FROM noise n", states=True, noise_=True))
def has_snapshot(spark, sf_dir):
    events, snaps = noise(spark, sf_dir).select("event_id", "t"), states(spark, sf_dir).select("snapshot_ts").distinct()
    found = joins.interval_join(events, snaps, "t", "snapshot_ts", 5).select("event_id").distinct().withColumn("has_snapshot", F.lit(True))
    return events.join(found, "event_id", "left").select("event_id", F.coalesce("has_snapshot", F.lit(False)).alias("has_snapshot"))


_STATIONS_SQL = "(VALUES " + ", ".join(f"('{a}', CAST({b} AS DOUBLE), CAST({c} AS DOUBLE), '{d}')" for a, b, c, d in STATIONS) + ") s(station, st_lat, st_lon, airport)"


@query(f"SELECT e.event_id, s.station, s.st_lat, s.st_lon, s.airport FROM events e LEFT JOIN {_STATIONS_SQL} ON s.airport = CASE e.user_id % 3 WHEN 0 THEN 'CDG' WHEN 1 THEN 'ORY' ELSE 'LBG' END")
def station_dim(spark, sf_dir):
    rows = views.events(spark, sf_dir).selectExpr("event_id", "case user_id % 3 when 0 then 'CDG' when 1 then 'ORY' else 'LBG' end as airport")
    dim = stations(spark)  # three fixed rows
    return rows.join(F.broadcast(dim.withColumnRenamed("airport", "a")), F.col("a") == F.col("airport"), "left").select("event_id", "station", "st_lat", "st_lon", F.col("a").alias("airport"))


_SAMPLES_SQL = f"samples AS MATERIALIZED ({views.sql(views.SAMPLES, views.OTHERS)})"
_PEAK_SQL = "SELECT n.event_id, s.leq, s.azimuth, s.elevation, s.sample_t, count(*) OVER (PARTITION BY n.event_id) AS n_samples FROM {left} n JOIN samples s ON s.station = n.station AND abs(s.sample_t - n.max_ts_unix) <= {tol} WHERE s.valid AND s.leq IS NOT NULL QUALIFY row_number() OVER (PARTITION BY n.event_id ORDER BY s.leq DESC, s.sample_t, s.azimuth DESC) = 1"


@query(with_views(_PEAK_SQL.format(left="noise", tol=20), noise_=True, more=_SAMPLES_SQL))
def peak_sample(spark, sf_dir):
    return joins.peak_samples(noise(spark, sf_dir), views.view(spark, sf_dir, views.SAMPLES, views.OTHERS), 20.0)


_BRG = G.bearing("n.st_lat", "n.st_lon", "n.aircraft_lat", "n.aircraft_lon")


_AZIMUTH_SQL = on_pairs("").rstrip() + f", {_SAMPLES_SQL}, loud AS (SELECT * FROM pairs WHERE slant_km <= 12 ORDER BY max_laeq DESC, event_id LIMIT 20), peak AS ({_PEAK_SQL.format(left='loud', tol=60)}) SELECT n.event_id, n.max_laeq, n.slant_km, p.azimuth AS az_measured, round({_BRG}, 1) AS az_bearing, round({G.ang_diff('p.azimuth', _BRG)}, 1) AS az_diff, p.elevation AS elev_measured, round(degrees(atan2(greatest(n.altitude_m, 0.0), greatest(n.horiz_km * 1000, 1.0))), 1) AS elev_geom FROM loud n JOIN peak p ON p.event_id = n.event_id"


@query(_AZIMUTH_SQL)
def azimuth_check(spark, sf_dir):
    events = noise(spark, sf_dir)
    return gate.azimuth_check(pairs(spark, sf_dir), events, views.view(spark, sf_dir, views.SAMPLES, views.OTHERS), tol=60.0)


_HEAD, _TAIL = _AZIMUTH_SQL[: _AZIMUTH_SQL.rindex(" SELECT n.event_id, n.max_laeq")], _AZIMUTH_SQL[_AZIMUTH_SQL.rindex(" SELECT n.event_id, n.max_laeq") :]


@query(f"{_HEAD}, checked AS ({_TAIL}) SELECT count(*) AS n, round(median(az_diff), 1) AS median_az_diff, round(100 * avg(CASE WHEN az_diff <= 45 THEN 1e0 ELSE 0e0 END), 0) AS coherent_pct, count(*) FILTER (az_diff < 30) AS below_30, count(*) FILTER (az_diff < 45) AS below_45, round(median(elev_measured), 1) AS median_elev_measured, round(median(elev_geom), 1) AS median_elev_geom FROM checked WHERE az_diff IS NOT NULL")
def azimuth_summary(spark, sf_dir):
    return gate.azimuth_summary(azimuth_check(spark, sf_dir))


# ---------------------------------------------------------------- gate

_GB = "(a.snapshot_ts - b.snapshot_ts)"
_GM = G.move("n.latitude", "n.longitude", "n.heading_deg", "n.velocity_m_s * (t - n.snapshot_ts)")
_METHOD = f"CASE WHEN {_GB} = 0 THEN 'snap' WHEN {_GB} <= 35 AND t - b.snapshot_ts <= 15 AND a.snapshot_ts - t <= 15 THEN 'bracket' WHEN abs(t - n.snapshot_ts) > 15 THEN NULL WHEN n.velocity_m_s > 0 AND n.heading_deg IS NOT NULL THEN 'deadreckon' ELSE 'snap' END"


def _gplace(c: str, reckoned: str) -> str:
    return f"CASE WHEN {_GB} = 0 THEN b.{c} WHEN method = 'bracket' THEN b.{c} + (t - b.snapshot_ts) / {_GB} * (a.{c} - b.{c}) WHEN method = 'deadreckon' THEN {reckoned} ELSE n.{c} END"


_GH = G.haversine_km("e.st_lat", "e.st_lon", "p.lat", "p.lon")
GATE_CTE = f"""
air AS MATERIALIZED (SELECT * FROM states WHERE baro_altitude_m IS NOT NULL),
inwin AS MATERIALIZED (SELECT * FROM noise WHERE max_ts_unix BETWEEN (SELECT min(snapshot_ts) FROM states) AND (SELECT max(snapshot_ts) FROM states)),
cand AS MATERIALIZED (SELECT *, {_METHOD} AS method FROM ({_candidates_sql('air', 35)})),
gp AS MATERIALIZED (SELECT *, {_gplace('latitude', _GM[0])} AS lat, {_gplace('longitude', _GM[1])} AS lon, {_gplace('baro_altitude_m', 'n.baro_altitude_m')} AS alt FROM cand WHERE method IS NOT NULL),
gs AS MATERIALIZED (SELECT p.event_id, p.icao24, p.last_callsign AS callsign, p.method, p.alt, {_GH} AS horiz, sqrt(({_GH} * 1000) * ({_GH} * 1000) + p.alt * p.alt) / 1000 AS slant, {G.bearing('e.st_lat', 'e.st_lon', 'p.lat', 'p.lon')} AS bearing,
 degrees(atan2(p.alt, greatest({_GH} * 1000, 1.0))) AS elevation FROM gp p JOIN inwin e ON e.event_id = p.event_id WHERE {_GH} <= 12),
gr AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY event_id) AS n_cand, lead(slant) OVER (PARTITION BY event_id ORDER BY slant, icao24) AS second, row_number() OVER (PARTITION BY event_id ORDER BY slant, icao24) AS rn FROM gs),
near_snap AS MATERIALIZED (SELECT DISTINCT e.event_id FROM inwin e JOIN (SELECT DISTINCT snapshot_ts FROM states) s ON abs(s.snapshot_ts - e.t) <= 35),
gate AS MATERIALIZED (SELECT e.event_id, e.station, e.max_laeq, e.max_ts_unix, CASE WHEN ns.event_id IS NULL THEN 'no_snapshot' WHEN r.event_id IS NULL THEN 'no_candidate' WHEN r.slant <= 10 AND (r.second IS NULL OR r.second - r.slant >= 3) THEN 'clean' WHEN r.slant <= 10 THEN 'ambiguous' ELSE 'far' END AS status,
 coalesce(r.n_cand, 0) AS n_cand, r.icao24 AS m_icao24, r.callsign AS m_callsign, r.horiz AS m_horiz_km, r.alt AS m_alt_m, r.slant AS m_slant_km, r.bearing AS m_bearing_deg, r.elevation AS m_elev_deg, r.method AS m_method, r.second AS second_slant_km
 FROM inwin e LEFT JOIN (SELECT * FROM gr WHERE rn = 1) r ON r.event_id = e.event_id LEFT JOIN near_snap ns ON ns.event_id = e.event_id)
"""


def on_gate(sql: str) -> str:
    return with_views(sql, states=True, noise_=True, more=GATE_CTE)


def gate_rows(spark, sf_dir):
    return gate.gate_join(noise(spark, sf_dir), states(spark, sf_dir))


_GATE_COLS = ("m_horiz_km", "m_alt_m", "m_slant_km", "m_bearing_deg", "m_elev_deg", "second_slant_km")


@query(on_gate(f"SELECT event_id, station, status, n_cand, m_icao24, m_callsign, m_method, {', '.join(f'round({c}, 6) AS {c}' for c in _GATE_COLS)} FROM gate"))
def gate_join(spark, sf_dir):
    return rounded(gate_rows(spark, sf_dir).select("event_id", "station", "status", "n_cand", "m_icao24", "m_callsign", "m_method", *_GATE_COLS))


@query(on_gate("SELECT status, count(*) AS n FROM gate GROUP BY status"))
def gate_status(spark, sf_dir):
    return gate.status_counts(gate_rows(spark, sf_dir))


@query(on_gate("SELECT m AS margin_km, s AS max_slant_km, count(*) FILTER (m_slant_km <= s AND (second_slant_km IS NULL OR second_slant_km - m_slant_km >= m)) AS n_clean, round(100 * count(*) FILTER (m_slant_km <= s AND (second_slant_km IS NULL OR second_slant_km - m_slant_km >= m)) / count(*), 1) AS rate_pct FROM gate, (VALUES (2e0), (3e0), (5e0)) a(m), (VALUES (8e0), (10e0), (15e0)) b(s) GROUP BY m, s"))
def gate_sensitivity(spark, sf_dir):
    return gate.sensitivity(gate_rows(spark, sf_dir))


_RHO = "SELECT corr(rx, ry) AS rho, count(*) AS n FROM (SELECT rank() OVER (ORDER BY m_slant_km) + (count(*) OVER (PARTITION BY m_slant_km) - 1) / 2e0 AS rx, rank() OVER (ORDER BY max_laeq) + (count(*) OVER (PARTITION BY max_laeq) - 1) / 2e0 AS ry FROM gate WHERE status = 'clean')"


@query(on_gate(f"SELECT *, CASE WHEN rate_pct >= 40 AND coalesce(spearman <= -0.3, false) AND n_clean >= 20 THEN 'validated' ELSE 'to diagnose' END AS decision, array_to_string(list_filter([CASE WHEN NOT rate_pct >= 40 THEN 'rate' END, CASE WHEN NOT coalesce(spearman <= -0.3, false) THEN 'correlation' END, CASE WHEN NOT n_clean >= 20 THEN 'n' END], lambda x: x IS NOT NULL), ';') AS missing FROM (SELECT (SELECT count(*) FROM gate) AS n_events, (SELECT count(*) FROM gate WHERE status = 'clean') AS n_clean, round(100 * (SELECT count(*) FROM gate WHERE status = 'clean') / (SELECT count(*) FROM gate), 1) AS rate_pct, (SELECT CASE WHEN n >= 3 THEN round(rho, 3) END FROM ({_RHO})) AS spearman, (SELECT round(corr(m_slant_km, max_laeq), 3) FROM gate WHERE status = 'clean') AS pearson)"))
def gate_verdict(spark, sf_dir):
    return gate.gate_summary(materialised(gate_rows(spark, sf_dir), "gate"))


@query(with_views("SELECT event_id, max_ts_unix, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S') AS event_utc, s AS snapshot_ts, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S') AS snapshot_utc, round(abs(s - max_ts_unix), 1) AS gap_s FROM (SELECT e.event_id, e.t, e.max_ts_unix, (SELECT arg_min(snapshot_ts, abs(snapshot_ts - e.t) * 1e11 + snapshot_ts) FROM (SELECT DISTINCT snapshot_ts FROM states)) AS s FROM picked e)", states=True, noise_=True, more="inwin AS MATERIALIZED (SELECT * FROM noise WHERE max_ts_unix BETWEEN (SELECT min(snapshot_ts) FROM states) AND (SELECT max(snapshot_ts) FROM states)), picked AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY max_ts_unix, event_id) - 1 AS rn FROM inwin) WHERE rn % greatest(1, (SELECT count(*) FROM inwin) // 3) = 0 AND rn // greatest(1, (SELECT count(*) FROM inwin) // 3) < 3)"))
def timezone_check(spark, sf_dir):
    return gate.timezone_check(noise(spark, sf_dir), states(spark, sf_dir))


@query(with_views("SELECT event_id, max_ts_unix FROM (SELECT *, row_number() OVER (ORDER BY max_ts_unix, event_id) - 1 AS rn FROM noise) WHERE rn % greatest(1, (SELECT count(*) FROM noise) // 20) = 0 AND rn // greatest(1, (SELECT count(*) FROM noise) // 20) < 20", noise_=True))
def stride_sample(spark, sf_dir):
    return gate.stride_sample(noise(spark, sf_dir), 20).select("event_id", "max_ts_unix")


@query(on_pairs("SELECT event_id, max_laeq, slant_km FROM pairs WHERE slant_km <= 12 ORDER BY max_laeq DESC, event_id LIMIT 20"))
def topk_loudest(spark, sf_dir):
    return pairs(spark, sf_dir).where("slant_km <= 12").orderBy(F.desc("max_laeq"), "event_id").limit(20).select("event_id", "max_laeq", "slant_km")


@query(on_pairs("SELECT event_id, slant_km FROM pairs WHERE slant_km IS NOT NULL ORDER BY slant_km, event_id LIMIT 10"))
def topk_closest(spark, sf_dir):
    return pairs(spark, sf_dir).where("slant_km IS NOT NULL").orderBy("slant_km", "event_id").limit(10).select("event_id", "slant_km")


# ---------------------------------------------------------------- statistics

_Q = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


@query(with_views("SELECT station, count(*) AS n, true AS p25, true AS p50, true AS p75 FROM noise GROUP BY station", noise_=True))
def sketched_quantiles(spark, sf_dir):
    """Quantiles of the levels from a sketch for each station and day, merged over the days, and whether their ranks hold the
    stated error: the share of rows below, and of those not above, enclose the wanted one."""
    rows = noise(spark, sf_dir).select("station", F.to_date("ts").alias("day"), "laeq_db")
    parts = rows.groupBy("station", "day").agg(stats.quantile_sketch("laeq_db").alias("sketch"))
    found = stats.merged_quantiles(parts, "sketch", ["station"], _Q)
    rank = lambda hit: F.count_if(hit) / F.count("*")
    ranked = rows.join(found, "station").groupBy("station", "n").agg(*[((rank(F.col("laeq_db") < F.col(c)) - stats.SKETCH_RANK_ERROR <= q) & (rank(F.col("laeq_db") <= F.col(c)) + stats.SKETCH_RANK_ERROR >= q)).alias(c) for c, q in _Q.items()])
    return ranked.select("station", "n", *_Q)


_DISTINCT_BY = ["origin_country", "hour"]


@query(with_views("SELECT origin_country, hour, CAST(grouping(origin_country, hour) AS BIGINT) AS level, count(DISTINCT icao24) AS n_exact, true AS near FROM (SELECT *, CAST(hour(make_timestamp(snapshot_ts * 1000000)) AS INT) AS hour FROM states) GROUP BY CUBE(origin_country, hour)", states=True))
def sketched_distinct(spark, sf_dir):
    """Aircraft by country and hour with all totals, rolled up from sketches, beside the exact counts."""
    rows = states(spark, sf_dir).select("icao24", "origin_country", F.hour(F.timestamp_seconds("snapshot_ts")).alias("hour"))
    found = cube.distinct_cube(cube.distinct_parts(rows, _DISTINCT_BY, "icao24"), _DISTINCT_BY)
    exact = rows.cube(*_DISTINCT_BY).agg(F.grouping_id().cast("long").alias("level"), F.countDistinct("icao24").alias("n_exact"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*_DISTINCT_BY, "level")]
    both = exact.alias("a").join(found.alias("b"), reduce(lambda p, q: p & q, same))
    return both.select(*[f"a.{c}" for c in (*_DISTINCT_BY, "level")], "n_exact", (F.abs(F.col("n") - F.col("n_exact")) <= F.greatest(F.lit(1.0), cube.DISTINCT_ERROR * F.col("n_exact"))).alias("near"))


@query(on_pairs("SELECT round(corr(slant_km, max_laeq), 6) AS slant, round(corr(horiz_km, max_laeq), 6) AS horiz, round(corr(altitude_m, max_laeq), 6) AS altitude FROM pairs WHERE slant_km IS NOT NULL"))
def corr_pearson(spark, sf_dir):
    rows = pairs(spark, sf_dir).where("slant_km IS NOT NULL")
    return rows.agg(*[F.round(stats.pearson(c, "max_laeq"), 6).alias(n) for c, n in (("slant_km", "slant"), ("horiz_km", "horiz"), ("altitude_m", "altitude"))])


def _rank_sql(c: str) -> str:
    return f"rank() OVER (PARTITION BY station ORDER BY {c}) + (count(*) OVER (PARTITION BY station, {c}) - 1) / 2e0"


@query(on_pairs(f"SELECT station, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM (SELECT station, {_rank_sql('slant_km')} AS rx, {_rank_sql('max_laeq')} AS ry FROM pairs WHERE slant_km IS NOT NULL) GROUP BY station HAVING count(*) >= 5"))
def corr_spearman(spark, sf_dir):
    out = stats.spearman(pairs(spark, sf_dir), "slant_km", "max_laeq", ["station"], 5)
    return out.select("station", "n", F.round("rho", 6).alias("rho"))


@query()
def corr_pvalue(spark, sf_dir):
    out = stats.spearman(pairs(spark, sf_dir), "slant_km", "max_laeq", ["station"], 5)
    return out.withColumn("p", stats.correlation_pvalue(F.col("rho"), F.col("n").cast("double")))


@query(on_pairs("SELECT station, count(*) AS n, " + ", ".join(f"round(quantile_cont(slant_km, {q}), 6) AS {n}" for n, q in _Q.items()) + ", min(max_laeq) AS min_db, round(median(max_laeq), 6) AS median_db, max(max_laeq) AS max_db FROM pairs WHERE slant_km IS NOT NULL GROUP BY station"))
def slant_quantiles(spark, sf_dir):
    rows = materialised(pairs(spark, sf_dir).where("slant_km IS NOT NULL").select("station", "slant_km", "max_laeq"), "pairs")
    found = rows.groupBy("station").agg(F.count("*").alias("n"), F.min("max_laeq").alias("min_db"), F.max("max_laeq").alias("max_db"))
    found = found.join(stats.quantiles(rows, "slant_km", ["station"], _Q), "station").join(stats.quantiles(rows, "max_laeq", ["station"], {"median_db": 0.5}), "station")
    return rounded(found, 6)


@query(on_pairs("SELECT count(*) AS n_events, count(*) FILTER (n_candidates > 0) AS n_covered, round(100 * count(*) FILTER (n_candidates > 0) / count(*), 1) AS coverage_pct, " + ", ".join(f"count(*) FILTER (slant_km <= {k}) AS within_{k}" for k in (5, 8, 12, 20)) + " FROM pairs"))
def association_coverage(spark, sf_dir):
    n = F.count("*")
    return pairs(spark, sf_dir).agg(n.alias("n_events"), F.count_if(F.col("n_candidates") > 0).alias("n_covered"), F.round(F.try_divide(100 * F.count_if(F.col("n_candidates") > 0), n), 1).alias("coverage_pct"), *[F.count_if(F.col("slant_km") <= k).alias(f"within_{k}") for k in (5, 8, 12, 20)])


@query(with_views("SELECT icao24, count(*) AS n_states, round(avg(gap), 6) AS mean_gap_s, max(gap) AS max_gap_s FROM (SELECT icao24, snapshot_ts - lag(snapshot_ts) OVER (PARTITION BY icao24 ORDER BY snapshot_ts) AS gap FROM states) GROUP BY icao24", states=True))
def track_gaps(spark, sf_dir):
    w = Window.partitionBy("icao24").orderBy("snapshot_ts")
    rows = states(spark, sf_dir).withColumn("gap", F.col("snapshot_ts") - F.lag("snapshot_ts").over(w))
    return rows.groupBy("icao24").agg(F.count("*").alias("n_states"), F.round(F.avg("gap"), 6).alias("mean_gap_s"), F.max("gap").alias("max_gap_s"))


# ---------------------------------------------------------------- cube and figures

ENRICHED_CTE = f"enriched AS MATERIALIZED (SELECT n.*, f.* EXCLUDE (event_id) FROM noise n JOIN ({FEATURES_SQL}) f ON f.event_id = n.event_id)"
_CUBE_SQL = "count(*) AS n_mesures, round(avg(laeq_db), 2) AS laeq_moyen_db, round(max(laeq_db), 2) AS laeq_max_db, round(avg(num_aircraft), 2) AS avions_moyen FROM enriched GROUP BY CUBE(airport, is_night, is_weekend)"


def on_enriched(sql: str) -> str:
    return with_views(sql, states=True, noise_=True, more=ENRICHED_CTE)


def enriched(spark, sf_dir):
    return joins.spatio_temporal_join(noise(spark, sf_dir), states(spark, sf_dir))


@query(on_enriched(f"SELECT coalesce(airport, 'TOUS') AS airport, CASE WHEN is_night = 1 THEN 'nuit' ELSE 'jour' END AS periode, CASE WHEN is_weekend = 1 THEN 'we' ELSE 'semaine' END AS type_jour, CAST(grouping(airport, is_night, is_weekend) AS BIGINT) AS niveau_agregation, {_CUBE_SQL}"))
def cube_noise(spark, sf_dir):
    return cube.cube_noise(enriched(spark, sf_dir))


@query(on_enriched(f"SELECT CASE WHEN grouping(airport) = 1 THEN 'TOUS' ELSE airport END AS airport, CASE WHEN grouping(is_night) = 1 THEN 'TOUS' WHEN is_night = 1 THEN 'nuit' ELSE 'jour' END AS periode, CASE WHEN grouping(is_weekend) = 1 THEN 'TOUS' WHEN is_weekend = 1 THEN 'we' ELSE 'semaine' END AS type_jour, CAST(grouping(airport, is_night, is_weekend) AS BIGINT) AS niveau_agregation, {_CUBE_SQL}"))
def cube_noise_labelled(spark, sf_dir):
    return cube.cube_noise(enriched(spark, sf_dir), labelled=True)


@query(on_enriched("SELECT CAST(hour AS INT) AS hour, is_night, is_weekend, CAST(airport AS VARCHAR) AS airport, num_aircraft, num_close_aircraft, round(avg_altitude_m, 6) AS avg_altitude_m, round(min_distance_km, 6) AS min_distance_km, round(laeq_db, 6) AS laeq_db FROM enriched WHERE laeq_db IS NOT NULL"))
def training_frame(spark, sf_dir):
    names = ("hour", "is_night", "is_weekend", "airport", "num_aircraft", "num_close_aircraft", "avg_altitude_m", "min_distance_km", "laeq_db")
    return rounded(frame(enriched(spark, sf_dir))).select(*names)


@query(on_enriched("SELECT count(*) AS n_rows, count(*) FILTER (num_aircraft > 0) AS n_with_aircraft, round(100 * count(*) FILTER (num_aircraft > 0) / count(*), 1) AS pct, round(avg(laeq_db), 2) AS mean_db, round(min(laeq_db), 2) AS min_db, round(max(laeq_db), 2) AS max_db FROM enriched"))
def real_diagnostic(spark, sf_dir):
    some = F.count_if(F.col("num_aircraft") > 0)
    return enriched(spark, sf_dir).agg(F.count("*").alias("n_rows"), some.alias("n_with_aircraft"), F.round(F.try_divide(100 * some, F.count("*")), 1).alias("pct"), *[F.round(f("laeq_db"), 2).alias(n) for f, n in ((F.avg, "mean_db"), (F.min, "min_db"), (F.max, "max_db"))])


@query(with_views("SELECT (SELECT count(*) FROM noise) AS n_measures, (SELECT count(DISTINCT station) FROM noise) AS n_stations, (SELECT count(*) FROM states) AS n_states, (SELECT round(avg(laeq_db), 2) FROM noise) AS mean_db", states=True, noise_=True))
def overview_kpis(spark, sf_dir):
    a = noise(spark, sf_dir).agg(F.count("*").alias("n_measures"), F.countDistinct("station").alias("n_stations"), F.round(F.avg("laeq_db"), 2).alias("mean_db"), F.lit(1).alias("_k"))
    return a.join(states(spark, sf_dir).agg(F.count("*").alias("n_states"), F.lit(1).alias("_k")), "_k").select("n_measures", "n_stations", "n_states", "mean_db")


@query(with_views("SELECT station, is_night, round(10 * log10(sum(pow(10.0, laeq_db / 10)) + pow(10.0, (CASE WHEN is_night = 1 THEN 39.0 ELSE 44.0 END) / 10)), 6) AS level_db FROM noise GROUP BY station, is_night", noise_=True))
def energy_sum_db(spark, sf_dir):
    ambient = F.when(F.col("is_night") == 1, acoustic.AMBIENT_NIGHT_DB).otherwise(acoustic.AMBIENT_DAY_DB)
    return noise(spark, sf_dir).groupBy("station", "is_night").agg(F.round(acoustic.energy_sum_db(F.col("laeq_db"), ambient), 6).alias("level_db"))


_LEVEL = f"(CASE WHEN coalesce(s.baro_altitude_m, 0.0) > 800 THEN 139.0 ELSE 132.0 END - 20 * log10(greatest(1000 * {G.slant_km(G.haversine_km('n.st_lat', 'n.st_lon', 's.latitude', 's.longitude'), 'coalesce(s.baro_altitude_m, 0.0)')}, 50.0)) - 8)"


@query(with_views(f"SELECT event_id, round(10 * log10(sum(pow(10.0, l / 10)) + pow(10.0, max(a) / 10)), 6) AS level_db, round(max(l), 6) AS max_level_db FROM (SELECT n.event_id, {_LEVEL} AS l, CASE WHEN n.hour >= 6 AND n.hour < 22 THEN 44.0 ELSE 39.0 END AS a FROM noise n JOIN states s ON abs(s.snapshot_ts - n.t) <= 45) GROUP BY event_id", states=True, noise_=True))
def physics_level(spark, sf_dir):
    events = noise(spark, sf_dir).select("event_id", "st_lat", "st_lon", "t", acoustic.ambient_db(F.col("hour")).alias("ambient_db"))
    air = states(spark, sf_dir).select("snapshot_ts", "latitude", "longitude", F.coalesce("baro_altitude_m", F.lit(0.0)).alias("altitude_m"))
    return rounded(cube.physics_level_of(events, air, 45, heavy_above_m=800.0))


_METRICS_SQL = f"SELECT *, CASE WHEN duration_ms <= 0 THEN 0.0 ELSE round(rows / (duration_ms / 1000), 1) END AS throughput_rows_per_s FROM ({views.sql(views.METRICS)})"


def metrics(spark, sf_dir):
    return views.view(spark, sf_dir, views.METRICS).withColumn("throughput_rows_per_s", cube.throughput(F.col("rows"), F.col("duration_ms")))


@query(f"SELECT count(*) AS batches, count(*) FILTER (ok) AS batches_ok, CAST(sum(rows) AS BIGINT) AS rows_total, round(quantile_disc(duration_ms, 0.5 ORDER BY duration_ms DESC), 1) AS latency_ms_p50, round(max(duration_ms), 1) AS latency_ms_max, round(avg(throughput_rows_per_s), 1) AS throughput_rows_per_s_avg, CAST(sum(bytes_written) AS BIGINT) AS bytes_total FROM ({_METRICS_SQL})".replace("quantile_disc(duration_ms, 0.5 ORDER BY duration_ms DESC)", "percentile_disc(0.5) WITHIN GROUP (ORDER BY duration_ms DESC)"))
def monitoring_summary(spark, sf_dir):
    return cube.monitoring_summary(metrics(spark, sf_dir))


@query(f"SELECT count(*) AS batches, count(*) FILTER (ok) AS batches_ok, CAST(sum(rows) AS BIGINT) AS rows_ingested, round(sum(duration_ms) / 1000, 2) AS cycle_seconds FROM ({_METRICS_SQL})")
def cycle_summary(spark, sf_dir):
    return cube.cycle_summary(metrics(spark, sf_dir))


_FAILS = "(user_id % 6 + day(ts)) % 5 = 0"
_REPORT_SQL = f"SELECT a.station, a.collect_day, count(f.event_id) AS air_events, CASE WHEN a.error IS NULL THEN count(DISTINCT f.event_id) ELSE 0 END AS written, a.error IS NULL AS ok, a.error FROM (SELECT user_id % 6 AS station, strftime(ts, '%Y-%m-%d') AS collect_day, max(CASE WHEN {_FAILS} THEN 'timeout' END) AS error FROM events GROUP BY ALL) a LEFT JOIN ({_FETCH_A} UNION ALL {_FETCH_B}) f ON f.station = a.station AND f.collect_day = a.collect_day GROUP BY a.station, a.collect_day, a.error"


def report(spark, sf_dir):
    """A fifth of the station-days fail."""
    attempts = views.events(spark, sf_dir).selectExpr("user_id % 6 as station", "date_format(ts, 'yyyy-MM-dd') as collect_day", f"case when {_FAILS} then 'timeout' end as error")
    return cube.collect_report(attempts, fetches(spark, sf_dir))


@query(_REPORT_SQL)
def collect_metrics(spark, sf_dir):
    return report(spark, sf_dir)


@query(f"SELECT count(*) AS station_days, count(*) FILTER (ok) AS station_days_ok, CAST(sum(air_events) AS BIGINT) AS air_events_total, CAST(sum(written) AS BIGINT) AS written_total FROM ({_REPORT_SQL})")
def collect_summary(spark, sf_dir):
    return cube.collect_summary(report(spark, sf_dir))
