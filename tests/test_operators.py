import math
import random

import pytest
from pyspark.sql import functions as F

from noisetrack.operators import clean, gate, joins
from noisetrack.schemas import AIRCRAFT_FEATURES, STATES, empty_states
from noisetrack.sources import landing

NOISE = "station_id string, timestamp_iso string, LAeq_dB string, Lmax_dB string, latitude string, longitude string, airport string"
EVENTS = "event_id long, station string, st_lat double, st_lon double, max_laeq double, max_ts_unix double"


def state(icao, ts, lat, lon, alt=500.0, vel=100.0, hdg=0.0, vr=None, ground=False, contact=None, callsign="AFR1"):
    return (icao, callsign, "France", ts, contact if contact is not None else ts, lon, lat, alt, vel, hdg, vr, "7000", ground, ts)


def states(spark, *rows):
    return spark.createDataFrame(list(rows), STATES)


def test_clean_noise(spark):
    rows = [("S", "2026-06-15T03:00:00", "60", "70", "48", "2", "CDG")] * 2 + [("S", "2026-06-15T14:00:00", "999", "400", "48", "2", "CDG"), ("S", "never", "60", "70", "48", "2", "CDG")]
    out = {r.hour: r for r in clean.clean_noise(spark.createDataFrame(rows, NOISE)).collect()}
    assert set(out) == {3, 14} and out[3].is_night == 1 and out[14].is_night == 0 and out[14].laeq_db == 130 and out[14].lmax_db == 400


def test_clean_states_dedup_before_ground_filter(spark):
    df = states(spark, state("a", 1000, 48.0, 2.0, alt=-50.0), state("a", 1000, 48.0, 2.0, contact=999), state("b", 1000, 48.0, 2.0, ground=True, contact=1000), state("b", 1000, 48.0, 2.0, contact=900), state("c", 1000, None, 2.0))
    out = clean.clean_states(df).collect()
    assert [r.icao24 for r in out] == ["a"] and out[0].baro_altitude_m == 0


def test_clean_flights_duration(spark):
    schema = "flight_id string, first_seen_iso string, last_seen_iso string, avg_altitude_m string"
    df = spark.createDataFrame([("f", "2026-06-15T06:00:00.000000Z", "2026-06-15T08:00:00Z", "x"), ("g", "2026-06-15T06:00:00Z", "2026-06-18T08:00:00Z", "1")], schema)
    out = clean.clean_flights(df).collect()
    assert [r.duration_min for r in out] == [120.0] and out[0].avg_altitude_m is None


def test_quality_report(spark):
    r = clean.quality_report(spark.createDataFrame([(1, 3), (None, 4), (None, 4)], "a int, b int"), "t").first()
    assert (r.rows, r["columns"], r.duplicated_rows) == (3, 2, 1) and r.null_ratio == pytest.approx(0.3333)
    assert clean.quality_report(spark.createDataFrame([], "a int"), "t").first().rows == 0


def noise_row(spark, t=1000.0, lat=48.90, lon=2.50):
    return spark.createDataFrame([(1, "S", lat, lon, 70.0, t)], EVENTS).withColumn("t", F.col("max_ts_unix"))


def test_range_join(spark):
    s = states(spark, state("a", 1000, 48.905, 2.50, alt=800.0), state("b", 1000, 40.0, 2.0))
    r = joins.spatio_temporal_join(noise_row(spark), s).first()
    assert r.num_aircraft == 1 and r.min_distance_km < 2 and r.avg_altitude_m == 800
    late = joins.spatio_temporal_join(noise_row(spark, t=1000.0 + 1800), s).first()
    assert late.num_aircraft == 0
    none = joins.spatio_temporal_join(noise_row(spark), empty_states(spark)).first()
    assert all(none[c] == 0 for c in AIRCRAFT_FEATURES)
    assert joins.spatio_temporal_join(noise_row(spark), empty_states(spark), fill=False).first().min_distance_km is None


def kilometres(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(x)))


@pytest.mark.parametrize("radius", [2.0, 20.0, 900.0])
@pytest.mark.parametrize("lat", [0.0, 48.5, -70.0, 85.0, 89.9])
def test_grid_join_equals_brute_force(spark, radius, lat):
    """At all latitudes, at the poles and over the antimeridian."""
    rnd = random.Random(int(radius + lat))
    wide = radius / 111
    north = lambda: max(-90.0, min(90.0, rnd.uniform(lat - 2 * wide, lat + 2 * wide)))
    stretch = min(180.0, 2 * wide / max(0.01, math.cos(math.radians(lat))))

    def east():
        at = rnd.choice([2.5, 180.0]) + rnd.uniform(-stretch, stretch)
        return (at + 180) % 360 - 180

    ev = [(i, "S", north(), east(), 1.0, float(rnd.randint(0, 2000))) for i in range(40)]
    st = [state(str(i), rnd.randint(0, 2000), north(), east()) for i in range(400)]
    want = {e[0]: sum(abs(s[13] - e[5]) <= 300 and kilometres(e[2], e[3], s[6], s[5]) <= radius for s in st) for e in ev}
    df = spark.createDataFrame(ev, EVENTS).withColumn("t", F.col("max_ts_unix"))
    got = {r.event_id: r.num_aircraft for r in joins.spatio_temporal_join(df, states(spark, *st).repartition(3), radius_km=radius).collect()}
    assert got == want and sum(want.values()) > 0


def placed(spark, t, *rows):
    ev = spark.createDataFrame([(1, "S", 49.0, 2.5, 70.0, float(t))], EVENTS)
    return joins.estimate_position(joins.candidates(ev, states(spark, *rows), 45.0)).collect()


def test_interpolation_midpoint(spark):
    (r,) = placed(spark, 1015, state("a", 1000, 49.00, 2.5, alt=600.0), state("a", 1030, 49.02, 2.5, alt=660.0))
    assert r.lat == pytest.approx(49.01) and r.alt == pytest.approx(630)


def test_dead_reckoning_north(spark):
    (r,) = placed(spark, 1010, state("a", 1000, 49.0, 2.5, vr=2.0))
    assert r.lat > 49.0 and r.lon == pytest.approx(2.5) and r.alt == 520


def test_null_speed_is_unplaceable_null_heading_stays(spark):
    found = {r.icao24: r for r in placed(spark, 1010, state("a", 1000, 49.0, 2.5, vel=None), state("b", 1000, 49.0, 2.5, hdg=None), state("c", 1000, 49.0, 2.5, vel=0.0, alt=None))}
    assert found["a"].lat is None and found["b"].lat == 49.0 and found["c"].lat == 49.0 and found["c"].alt == 0


def test_nearest_is_chosen_and_missing_aircraft_give_nulls(spark):
    ev = spark.createDataFrame([(1, "S", 49.0, 2.5, 70.0, 1000.0), (2, "S", 49.0, 2.5, 70.0, 5000.0), (3, "S", 49.0, 2.5, 70.0, 3000.0)], EVENTS)
    st = states(spark, state("near", 1000, 49.0, 2.5), state("far", 1000, 49.1, 2.5, alt=3000.0), state("x", 3010, 49.0, 2.5, vel=None))
    got = {r.event_id: r for r in joins.build_pairs(ev, st).collect()}
    assert got[1].icao24 == "near" and got[1].n_candidates == 2 and got[1].slant_km < 1
    assert got[2].icao24 is None and got[2].n_candidates == 0
    assert got[3].icao24 is None and got[3].n_candidates == 1  # there, but unplaceable


def test_tie_goes_to_the_lowest_id(spark):
    ev = spark.createDataFrame([(1, "S", 49.0, 2.5, 70.0, 1000.0)], EVENTS)
    st = states(spark, *[state(i, 1000, 49.0, 2.5) for i in ("b", "a", "c")])
    assert joins.build_pairs(ev, st.repartition(3)).first().icao24 == "a"


def test_gate_status(spark):
    ev = spark.createDataFrame([(i, "S", 49.0, 2.5, 70.0, t) for i, t in enumerate((1000.0, 2000.0, 2500.0, 2900.0), 1)], EVENTS)
    st = states(spark, state("a", 1000, 49.0, 2.5), state("a", 2000, 49.0, 2.5), state("b", 2000, 49.01, 2.5), state("c", 3000, 49.0, 2.5), state("d", 2510, 45.0, 2.5))
    assert {r.event_id: r.status for r in gate.gate_join(ev, st).collect()} == {1: "clean", 2: "ambiguous", 3: "no_candidate", 4: "no_snapshot"}


def test_parse_states_payload(spark):
    payload = '{"time":1000,"states":[["abc","AFR1  ","France",999,1000,2.5,48.9,1000.0,false,200.0,90.0,0.0,null,1000.0,"7000",false,0],["def"]]}'
    rows = landing.parse_states(spark.createDataFrame([(payload,), ('{"time":1,"states":null}',)], "value string")).orderBy("icao24").collect()
    assert len(rows) == 2 and rows[0].callsign == "AFR1" and rows[0].latitude == 48.9 and rows[0].baro_altitude_m == 1000 and rows[1].time_position_unix == 1000


def test_normalize_event(spark):
    good = '{"category":"air","id":1,"start":"2026-06-15T10:00:00Z","end":"2026-06-15T10:00:39.1Z","max_ts":"2026-06-15T10:00:20+0000","max_laeq":77.37}'
    bad = [good.replace("77.37", "null"), good.replace('"2026-06-15T10:00:20+0000"', "null"), good.replace("air", "road")]
    rows = landing.normalize_events(spark.createDataFrame([(x,) for x in [good, *bad]], "value string")).collect()
    assert len(rows) == 1 and rows[0].duration_s == pytest.approx(39.1) and rows[0].max_laeq == 77.37 and rows[0].valid


def test_windows_with_the_same_events_dedup(spark):
    rows = [("S", "2026-06-15", i % 2, 70.0) for i in range(48)]
    assert clean.dedup_events(spark.createDataFrame(rows, "station string, collect_day string, event_id long, max_laeq double")).count() == 2


def test_missing_landing_zone_is_empty(spark, tmp_path):
    assert landing.read_or_empty(spark, str(tmp_path / "none"), STATES).count() == 0
    assert landing.read_metrics(spark, str(tmp_path / "none")).count() == 0


def test_rewriting_a_snapshot_changes_nothing(spark, tmp_path):
    df = states(spark, state("a", 1000, 48.0, 2.0), state("b", 1030, 48.0, 2.0), state("c", 9000, 48.0, 2.0))
    for part in (df, df, df.where("snapshot_ts = 1000")):
        landing.write_states(part, str(tmp_path / "states"))
    assert sorted(r.icao24 for r in landing.read_states(spark, str(tmp_path / "states")).collect()) == ["a", "b", "c"]
