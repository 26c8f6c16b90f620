"""Schemas of the landing zones and sources, and fixed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATES = (
    "icao24 string, callsign string, origin_country string, time_position_unix long, last_contact_unix long, longitude double, latitude double,"
    " baro_altitude_m double, velocity_m_s double, heading_deg double, vertical_rate_m_s double, squawk string, on_ground boolean, snapshot_ts long"
)
NOISE_EVENTS = (
    "airport string, latitude double, longitude double, event_id long, category string, start_ts_unix double, end_ts_unix double, max_ts_unix double,"
    " max_ts_iso string, duration_s double, laeq double, max_laeq double, sel double, nrj_laeq double, valid boolean, collect_day string"
)
NOISE_CSV = "station_id string, station_name string, timestamp_iso string, LAeq_dB string, Lmax_dB string, latitude string, longitude string, airport string"
FLIGHTS_CSV = (
    "flight_id string, callsign string, departure_icao string, arrival_icao string, first_seen_iso string, last_seen_iso string,"
    " avg_altitude_m string, avg_speed_knots string, approx_distance_km string"
)
SNAPSHOT_CSV = (
    "icao24 string, callsign string, origin_country string, time_position_unix string, longitude string, latitude string, baro_altitude_m string,"
    " velocity_m_s string, heading_deg string, squawk string, last_contact_unix string"
)
STATES_JSON = "time long, states array<array<string>>"
EVENT_JSON = "category string, id long, start string, end string, max_ts string, laeq double, max_laeq double, sel double, nrj_laeq double, valid boolean"
METRICS = (
    "batch_id string, mode string, snapshot_ts long, rows long, duration_ms double, bytes_written long, ok boolean, error string,"
    " credits_remaining long, throughput_rows_per_s double"
)

COLLECTION = "collected_at string, station string, day string, air_events long, written long, ok boolean, error string"

#: Places of a state in its array.
STATE_FIELDS = (
    "icao24 callsign origin_country time_position last_contact longitude latitude baro_altitude_m on_ground velocity_m_s true_track_deg"
    " vertical_rate_m_s sensors geo_altitude_m squawk spi position_source"
).split()
#: Measuring stations (id, latitude, longitude, airport).
STATIONS = (
    ("95500-GONESSE-MEDIATHEQUE-M", 48.985, 2.447118, "CDG"),
    ("94290-VILLENEUVE-LE-ROI-NOBLECOURT", 48.730312, 2.427967, "ORY"),
    ("95390-ST-PRIX-MAIRIE-M", 49.006393, 2.263266, "CDG"),
)
#: The area that is watched (south, west, north, east).
BOX = (48.65, 2.18, 49.09, 2.53)
AIRCRAFT_FEATURES = ("num_aircraft", "num_close_aircraft", "avg_altitude_m", "min_altitude_m", "avg_velocity_m_s", "min_distance_km", "avg_distance_km")


def stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "station string, st_lat double, st_lon double, airport string")


def empty_states(spark: SparkSession) -> DataFrame:
    """What stands for a landing zone without files."""
    return spark.createDataFrame([], STATES)
