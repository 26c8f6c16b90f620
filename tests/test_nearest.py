"""The nearest aircraft against brute force, wherever it flies and however fast."""

import math
import random

import pytest
from pyspark.sql import functions as F

from noisetrack.operators import cube, gate, joins
from test_operators import EVENTS, kilometres, state, states


def world(seed, lat, fast, n_events=25, n_crafts=60):
    """Events and tracks of aircraft around a latitude, some with gaps, at the antimeridian too, some very fast."""
    rnd = random.Random(seed)
    at = lambda: (max(-89.9, min(89.9, rnd.gauss(lat, 0.6))), (rnd.choice([2.5, 179.9]) + rnd.gauss(0, 1.0) + 180) % 360 - 180)
    ev = [(i, "S", *at(), 70.0, float(rnd.randint(0, 600))) for i in range(n_events)]
    st = []
    for k in range(n_crafts):
        (y, x), heading, speed = at(), rnd.uniform(0, 360), rnd.choice([0.0, 80.0, 250.0, fast])
        for t in range(0, 630, 30):
            if rnd.random() < 0.6:
                d = speed * t / 6_371_000 * 180 / math.pi
                north = max(-89.9, min(89.9, y + d * math.cos(math.radians(heading))))
                east = (x + d * math.sin(math.radians(heading)) / max(0.05, math.cos(math.radians(y))) + 180) % 360 - 180
                st.append(state(f"c{k}", t, north, east, alt=rnd.choice([None, 300.0, 9000.0]), vel=rnd.choice([speed, speed, None]), hdg=rnd.choice([heading, heading, None])))
    return ev, st


@pytest.mark.parametrize("lat,fast", [(48.9, 250.0), (48.9, 30_000.0), (86.0, 250.0), (-60.0, 3_000.0)])
def test_rings_and_cells_give_the_rows_of_all_pairs(spark, lat, fast):
    ev, st = world(int(lat + fast), lat, fast)
    events, air = spark.createDataFrame(ev, EVENTS), states(spark, *st)
    row = lambda r: tuple(r.asDict().items())
    everything = sorted(map(row, joins.build_pairs(events, air, rings=()).collect()))
    assert sorted(map(row, joins.build_pairs(events, air, rings=(5.0, 40.0)).collect())) == everything
    by_cells, by_time = (sorted(map(row, gate.gate_join(events, air.where("baro_altitude_m IS NOT NULL"), cells=c).drop("max_ts_unix").collect()), key=repr) for c in (True, False))
    assert by_cells == by_time
    # Against plain loops: the nearest of those that have a place.
    placed = joins.estimate_position(joins.candidates(events, air, 45.0)).collect()
    place = {e[0]: e for e in ev}
    best, seen = {}, {}
    for r in placed:
        seen[r.event_id] = seen.get(r.event_id, 0) + 1
        if r.lat is not None and r.lon is not None:
            e = place[r.event_id]
            key = (math.hypot(kilometres(e[2], e[3], r.lat, r.lon), max(r.alt, 0.0) / 1000), r.icao24)
            best[r.event_id] = min(best.get(r.event_id, key), key)
    for e in everything:
        r = dict(e)
        assert r["icao24"] == best.get(r["event_id"], (0, None))[1] and r["n_candidates"] == seen.get(r["event_id"], 0)


def test_cells_leave_fewer_pairs_where_traffic_is_spread(spark):
    rnd = random.Random(1)
    ev = spark.createDataFrame([(i, "S", rnd.uniform(45, 50), rnd.uniform(0, 5), 70.0, 1000.0) for i in range(50)], EVENTS)
    air = states(spark, *[state(str(k), 990, rnd.uniform(40, 55), rnd.uniform(-5, 10)) for k in range(3000)])
    near, track = joins.Near(10.0, 45.0), joins.tracked(air, 45.0)
    assert joins.pays(track, 45.0, near) and not joins.pays(track, 45.0, joins.Near(900.0, 45.0))
    keep = ("st_lat", "st_lon")
    assert joins.candidates(ev, air, 45.0, keep=keep, near=near).count() * 50 < joins.candidates(ev, air, 45.0, keep=keep).count()


def test_candidates_are_counted_without_pairs(spark):
    ev, st = world(3, 48.9, 250.0)
    events, air = spark.createDataFrame(ev, EVENTS), states(spark, *st)
    got = {r.event_id: r.n for r in joins.candidate_counts(events, air, 45.0).collect()}
    assert got == {e[0]: n for e in ev if (n := len({s[0] for s in st if abs(s[13] - e[5]) <= 45}))}


def test_bounds_are_subqueries(spark, tmp_path):
    spark.range(0, 1000, 1, 10).select("id", F.col("id").cast("double").alias("max_ts_unix")).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        inside = joins.events_in_window(events, states(spark, state("a", 110, 48.0, 2.0), state("b", 130, 48.0, 2.0)))
        assert len(inside.collect()) == 21
        read = inside._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "scalar-subquery" in inside._jdf.queryExecution().optimizedPlan().toString()
    assert read == 100  # of ten files one has rows between the bounds
    assert joins.events_in_window(events, states(spark)).count() == 0


def test_cut_tracks_give_the_candidates_of_whole_ones(spark):
    ev, st = world(11, 48.9, 250.0)
    events, air = spark.createDataFrame(ev, EVENTS), states(spark, *st)
    found = [sorted(repr(r) for r in joins.candidates(events, air, 45.0, track=joins.tracked(air, 45.0, cut_s=c)).collect()) for c in (70, 300, 10**9)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def dense(spark):
    """400 aircraft, some in one place, and 60 events of two stations at two times."""
    rnd = random.Random(5)
    at = [(rnd.uniform(48.6, 49.1), rnd.uniform(2.2, 2.6), rnd.choice([0.0, 600.0, 3000.0])) for _ in range(300)]
    air = states(spark, *[state(f"c{k}", 1000 + k % 2, *at[k % 300][:2], alt=at[k % 300][2], vel=0.0) for k in range(400)])
    ev = [(i, "S", 48.8 + 0.1 * (i % 2), 2.4, 60.0 + i, 1000.0 + 5 * (i % 4 // 2)) for i in range(60)]
    slants = {(e[2], e[5]): sorted((math.hypot(kilometres(e[2], e[3], at[k % 300][0], at[k % 300][1]), at[k % 300][2] / 1000), f"c{k}", kilometres(e[2], e[3], *at[k % 300][:2])) for k in range(400)) for e in ev}
    return ev, spark.createDataFrame(ev, EVENTS), air, slants


def test_events_of_one_time_and_place_are_one_search_and_few_pairs_are_sorted(spark):
    ev, events, air, slants = dense(spark)
    asking = joins.askers(events)
    assert asking.count() == len(slants) == 4
    kept = joins.placed_nearest(asking, air, 45.0, joins.tracked(air, 45.0)).count()
    assert 4 <= kept < 4 * 400 / 8 < 60 * 400
    got = {r.event_id: r for r in joins.build_pairs(events, air).collect()}
    assert len(got) == 60
    for e in ev:
        slant, icao, _ = slants[e[2], e[5]][0]
        r = got[e[0]]
        assert (r.icao24, r.n_candidates, r.max_laeq) == (icao, 400, e[4]) and r.slant_km == pytest.approx(slant, abs=6e-4)


def test_events_without_a_place_or_time_stay(spark):
    air = states(spark, state("a", 1000, 49.0, 2.5))
    ev = spark.createDataFrame([(1, "S", None, 2.5, 70.0, 1000.0), (2, "S", 49.0, 2.5, 70.0, None), (3, "S", None, 2.5, 71.0, 1000.0)], EVENTS)
    got = {r.event_id: (r.icao24, r.n_candidates, r.max_laeq) for r in joins.build_pairs(ev, air).collect()}
    assert got == {1: (None, 1, 70.0), 2: (None, 0, 70.0), 3: (None, 1, 71.0)}


def test_gate_counts_all_and_ranks_few(spark):
    ev, events, air, slants = dense(spark)
    got = {r.event_id: r for r in gate.gate_join(events, air).collect()}
    inside = {e[0] for e in ev if e[5] <= 1001}
    assert set(got) == inside
    for e in ev:
        if e[0] in inside:
            near = [s for s in slants[e[2], e[5]] if s[2] <= 12]
            r = got[e[0]]
            assert (r.m_icao24, r.n_cand, r.max_laeq) == (near[0][1], len(near), e[4])
            assert r.m_slant_km == pytest.approx(near[0][0]) and r.second_slant_km == pytest.approx(near[1][0])


def test_stations_share_distances(spark):
    """Features of two stations' dense measurements against plain loops; null speeds and a place that is missing."""
    rnd = random.Random(9)
    ev = [(i, "S", (48.8, 48.9, None)[i % 3], 2.4, 70.0, float(rnd.randint(0, 1500))) for i in range(150)]
    st = [state(str(i), rnd.randint(0, 1500), rnd.uniform(48.5, 49.2), rnd.uniform(2.0, 2.8), alt=rnd.choice([None, 100.0, 700.0]), vel=rnd.choice([None, 90.0, 120.0])) for i in range(200)]
    events = spark.createDataFrame(ev, EVENTS).withColumn("t", F.col("max_ts_unix"))
    binned = events.withColumn("_bin", joins.bins_around(F.col("t"), 300.0))
    assert joins.shared(binned, "_bin", "st_lat", "st_lon") and not joins.shared(binned, "_bin", "event_id")
    got = {r.event_id: r for r in joins.spatio_temporal_join(events, states(spark, *st), fill=False).collect()}
    assert len(got) == 150
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    for e in ev:
        near = [(kilometres(e[2], e[3], s[6], s[5]), s[7], s[8]) for s in st if e[2] is not None and abs(s[13] - e[5]) <= 300]
        near = [x for x in near if x[0] <= 20]
        heights, speeds, r = [h for _, h, _ in near if h is not None], [v for _, _, v in near if v is not None], got[e[0]]
        assert (r.num_aircraft or 0, r.num_close_aircraft or 0) == (len(near), sum(d <= 5 for d, _, _ in near))
        want = (mean(heights), min(heights, default=None), mean(speeds), min((d for d, _, _ in near), default=None), mean([d for d, _, _ in near]))
        assert (r.avg_altitude_m, r.min_altitude_m, r.avg_velocity_m_s, r.min_distance_km, r.avg_distance_km) == pytest.approx(want)


def test_peaks_and_levels_of_shared_times_equal_plain_loops(spark):
    rnd = random.Random(4)
    ev = [(i, rnd.choice("AB"), (48.8, 48.9)[i % 2], 2.4, 70.0, float(rnd.randint(0, 60))) for i in range(80)]
    events = spark.createDataFrame(ev, EVENTS)
    heard = [(rnd.choice("AB"), rnd.randint(0, 60), rnd.choice([None, 50.0, 60.0, 70.0]), float(k), 1.0, rnd.random() < 0.8) for k in range(200)]
    samples = spark.createDataFrame(heard, "station string, sample_t long, leq double, azimuth double, elevation double, valid boolean")
    got = {r.event_id: (r.leq, r.azimuth, r.sample_t, r.n_samples) for r in joins.peak_samples(events, samples, 8.0).collect()}
    for e in ev:
        near = [s for s in heard if s[0] == e[1] and abs(s[1] - e[5]) <= 8 and s[5] and s[2] is not None]
        best = max(near, key=lambda s: (s[2], -s[1], s[3]), default=None)
        assert got.get(e[0]) == (best and (best[2], best[3], best[1], len(near)))
    st = [(30 * rnd.randint(0, 3), rnd.uniform(48.6, 49.0), 2.4, rnd.choice([0.0, 500.0, 900.0])) for _ in range(90)]
    air = spark.createDataFrame(st, "snapshot_ts long, latitude double, longitude double, altitude_m double")
    asked = events.select("event_id", "st_lat", "st_lon", F.col("max_ts_unix").alias("t"), F.lit(44.0).alias("ambient_db"))
    levels = {r.event_id: (r.level_db, r.max_level_db) for r in cube.physics_level_of(asked, air, 20.0, 800.0).collect()}
    for e in ev:
        each = [(139 if s[3] > 800 else 132) - 8 - 20 * math.log10(max(50.0, 1000 * math.hypot(kilometres(e[2], e[3], s[1], s[2]), s[3] / 1000))) for s in st if abs(s[0] - e[5]) <= 20]
        assert levels.get(e[0]) == (pytest.approx((10 * math.log10(sum(10 ** (x / 10) for x in [*each, 44.0])), max(each))) if each else None)


def test_events_of_one_time_meet_aircraft_together(spark, monkeypatch):
    """Rows that are lists of events give the pairs of single events, in lists cut small too; an event without a time has none."""
    ev, st = world(7, 48.9, 250.0)
    ev = [(i * 100 + k, *e[1:]) for i, e in enumerate(ev) for k in range(5)] + [(-1, "S", 48.9, 2.5, 70.0, None), (None, "S", 48.9, 2.5, 70.0, 30.0), (None, "S", 48.9, 2.5, 70.0, 30.0)]
    events, air = spark.createDataFrame(ev, EVENTS), states(spark, *st)
    rows = lambda df: sorted(map(repr, df.collect()))
    columns = ("event_id", "icao24", "lat", "lon", "alt", "bracketed")
    single = rows(joins.estimate_position(joins.candidates(events, air, 45.0)).select(*columns))
    times, seen = events.select("event_id", "max_ts_unix"), air.select("icao24", "snapshot_ts")
    pairs = rows(joins.interval_join(times, seen, "max_ts_unix", "snapshot_ts", 45).select("event_id", "max_ts_unix", "icao24", "snapshot_ts"))
    for most in (2, 1_000):
        monkeypatch.setattr(joins, "TOGETHER", most)
        asking = joins.asking_together(events)
        assert asking.selectExpr("sum(size(_asking))").first()[0] == len(ev) - 1
        assert asking.count() == len({e[5] for e in ev if e[5] is not None}) or most == 2
        found = joins.candidates(asking, air, 45.0, keep=("_asking",))
        assert found.count() * 4 < len(single) or most == 2
        assert rows(joins.each_asker(joins.estimate_position(found)).select(*columns)) == single
        assert rows(joins.interval_pairs(times, seen, "max_ts_unix", "snapshot_ts", 45).select("event_id", "max_ts_unix", "icao24", "snapshot_ts")) == pairs
