"""Landing zones, logs, curated tables and streams."""

import pytest
from pyspark.sql import functions as F

from noisetrack.operators import joins
from noisetrack.schemas import AIRCRAFT_FEATURES
from noisetrack.sources import landing, zone
from noisetrack.streaming import jobs

STATE = "icao24 string, snapshot_ts long, latitude double"


def rows(spark, *more):
    return spark.createDataFrame(list(more), STATE)


def ids(df):
    return sorted((r.icao24, r.snapshot_ts) for r in df.select("icao24", "snapshot_ts").collect())


def test_a_batch_replaces_its_snapshots_only(spark, tmp_path):
    root = str(tmp_path / "zone")
    first = landing.write_states(rows(spark, ("a", 1000, 1.0), ("b", 1000, 1.0), ("c", 9000, 1.0)), root)
    assert (first.rows, first.bytes) == (3, zone.files_of(spark, f"{root}/batches")[1])
    landing.write_states(rows(spark, ("d", 1000, 2.0)), root)
    assert ids(landing.read_states(spark, root)) == [("c", 9000), ("d", 1000)]
    landing.write_states(rows(spark, ("e", 9000, 3.0)), root)  # nothing of the first batch is left
    assert ids(landing.read_states(spark, root)) == [("d", 1000), ("e", 9000)]
    day = landing.read_states(spark, root).where("date = DATE '1970-01-01' AND hour = 2")
    assert ids(day) == [("e", 9000)] and "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().toString()


def test_an_empty_batch_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "zone")
    assert landing.write_states(rows(spark), root) == zone.Written(None, 0, 0)
    assert landing.read_states(spark, root).count() == 0 and {"date", "hour"} <= set(landing.read_states(spark, root).columns)
    landing.write_states(rows(spark, ("a", 1000, 1.0)), root)
    landing.write_states(rows(spark, ("a", 1000, 1.0)).where("latitude > 5"), root)
    assert ids(landing.read_states(spark, root)) == [("a", 1000)]


def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "zone")
    landing.write_states(rows(spark, ("a", 1000, 1.0)), root)
    bad = rows(spark, ("b", 1000, 1.0), ("c", 1000, 0.0)).withColumn("latitude", F.when(F.col("icao24") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("latitude")))
    with pytest.raises(Exception, match="lost"):
        landing.write_states(bad, root)
    assert ids(landing.read_states(spark, root)) == [("a", 1000)]

    monkeypatch.setattr(zone, "_next_seq", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))  # all rows written, no manifest
    with pytest.raises(KeyboardInterrupt):
        landing.write_states(rows(spark, ("b", 1000, 1.0)), root)
    monkeypatch.undo()
    assert ids(landing.read_states(spark, root)) == [("a", 1000)]
    landing.write_states(rows(spark, ("b", 1000, 1.0)), root)
    assert ids(landing.read_states(spark, root)) == [("b", 1000)]


def test_one_hour_is_split_into_files_by_size(spark, tmp_path):
    root, size = str(tmp_path / "zone"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(400_000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("icao24"), (F.col("id") % 100 + 3600).alias("snapshot_ts"), F.rand(1).alias("latitude")).repartition(8)
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        landing.write_states(hot, root)
    finally:
        spark.conf.set(size, before)
    files = [f.stat().st_size for f in tmp_path.rglob("*.parquet")]
    assert len(files) >= 4 and max(files) < 3 * sum(files) / len(files)
    assert landing.read_states(spark, root).count() == 400_000


def test_compaction_keeps_the_rows(spark, tmp_path):
    root = str(tmp_path / "zone")
    for k in range(4):
        landing.write_states(rows(spark, (f"x{k}", 1000, 1.0), (f"y{k}", 1000 + k, 1.0)), root)
    want = ids(landing.read_states(spark, root))
    landing.zone.compact(spark, root, landing.STATES_ZONE)
    assert ids(landing.read_states(spark, root)) == want and len(list((tmp_path / "zone" / "manifests").iterdir())) == 1 == len(list((tmp_path / "zone" / "batches").iterdir()))


def test_events_by_station_and_day(spark, tmp_path):
    root = str(tmp_path / "zone")
    df = spark.createDataFrame([("A", 1, 1000.0), ("A", 2, 90_000.0), ("B", 3, 1000.0)], "station string, event_id long, max_ts_unix double")
    landing.write_events(df, root)
    landing.write_events(df.where("event_id = 1").withColumn("event_id", F.lit(9).cast("long")), root)
    assert sorted(r.event_id for r in landing.read_events(spark, root).collect()) == [2, 3, 9]


def test_each_batch_is_computed_once(spark, tmp_path):
    source, root, log = str(tmp_path / "in"), str(tmp_path / "zone"), str(tmp_path / "log")
    rows(spark, *[(f"a{k}", 1000 + k % 3, 1.0) for k in range(50)]).coalesce(1).write.parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def one(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    stream = jobs.read_landing(spark, source, STATE).mapInArrow(one, STATE)
    jobs.ingest(stream, root, str(tmp_path / "checkpoint"), log=log).awaitTermination()
    (row,) = landing.read_metrics(spark, log).collect()
    assert seen.value == 50 == row.rows and row.snapshot_ts == 1002 and row.bytes_written == zone.files_of(spark, f"{root}/batches")[1] > 0


def test_live_range_join_gives_zeros_where_nothing_comes(spark, tmp_path):
    noise_path, states_path = str(tmp_path / "noise"), str(tmp_path / "states")
    noise = "event_id long, t long, st_lat double, st_lon double"
    states = "time_position_unix long, latitude double, longitude double, baro_altitude_m double, velocity_m_s double"
    near = (1100, 48.905, 2.5, 800.0, 100.0)
    spark.createDataFrame([(1, 1000, 48.9, 2.5), (2, 1000, 10.0, 10.0), (3, 1_800, 48.9, 2.5)], noise).write.parquet(noise_path)
    spark.createDataFrame([near, (1200, 48.9, 2.9, 500.0, 90.0)], states).write.parquet(states_path)

    def run():
        joined = jobs.spatio_temporal_join(jobs.read_landing(spark, noise_path, noise), jobs.read_landing(spark, states_path, states), delay="1 minute")
        jobs.start(joined, str(tmp_path / "checkpoint"), path=str(tmp_path / "out")).awaitTermination()
        return {r.event_id: r for r in spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).collect()}

    assert 3 not in run()  # an aircraft might still come
    spark.createDataFrame([(9, 10_000, 0.0, 0.0)], noise).write.mode("append").parquet(noise_path)
    spark.createDataFrame([(10_000, 0.0, 0.0, 0.0, 0.0)], states).write.mode("append").parquet(states_path)
    got = run()
    assert set(got) == {1, 2, 3} and got[1].num_aircraft == 1 and got[1].min_distance_km < 2 and got[1].avg_altitude_m == 800
    assert all(got[k][c] == 0 for k in (2, 3) for c in AIRCRAFT_FEATURES)


def test_live_range_join_keeps_a_place_once_and_equals_the_batch_join(spark, tmp_path):
    """Sixty measurements of two times and places: the join with the states waits with places, not with measurements."""
    noise, states = "event_id long, t long, st_lat double, st_lon double", "time_position_unix long, latitude double, longitude double, baro_altitude_m double, velocity_m_s double"
    events = spark.createDataFrame([(i, (1000, 1700)[i % 2], (48.9, 48.8, None)[i % 3], 2.5) for i in range(60)], noise)
    air = spark.createDataFrame([(700 + 13 * k, 48.7 + 0.003 * k, 2.4, (None, 500.0, 900.0)[k % 3], 90.0 + k) for k in range(100)], states)
    last = spark.createDataFrame([(-1, 100_000, 0.0, 0.0)], noise), spark.createDataFrame([(100_000, 0.0, 0.0, 0.0, 0.0)], states)
    for df, end, name in ((events, last[0], "noise"), (air, last[1], "states")):
        df.unionByName(end).coalesce(1).write.parquet(str(tmp_path / name))
    joined = jobs.spatio_temporal_join(jobs.read_landing(spark, str(tmp_path / "noise"), noise), jobs.read_landing(spark, str(tmp_path / "states"), states), delay="1 minute")
    run = jobs.start(joined, str(tmp_path / "checkpoint"), path=str(tmp_path / "out"))
    run.awaitTermination()
    got = {r.event_id: r for r in spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).collect()}
    want = {r.event_id: r for r in joins.spatio_temporal_join(events, air).collect()}
    assert set(got) == set(want) == set(range(60)) and any(r.num_aircraft for r in want.values())
    for k, r in want.items():
        assert [got[k][c] for c in AIRCRAFT_FEATURES] == pytest.approx([r[c] for c in AIRCRAFT_FEATURES])
    held = [o["numRowsTotal"] for p in run.recentProgress for o in p["stateOperators"] if "Join" in o["operatorName"]]
    assert 0 < max(held) < 60 * 9  # a measurement in each cell before


def test_tables_of_a_database(spark):
    import uuid

    name = f"test_{uuid.uuid4().hex}"
    assert landing.list_tables(spark, name).count() == 0
    df = rows(spark, ("a", 1000, 1.0))
    try:
        for _ in range(2):
            assert landing.save_tables({"states": df, "flights": df}, name) == [f"{name}.states", f"{name}.flights"]
        assert [r.name for r in landing.list_tables(spark, name).collect()] == ["flights", "states"]
        assert {r.table: r.rows for r in landing.table_counts(spark, [f"{name}.states", f"{name}.nothing"]).collect()} == {f"{name}.states": 1}
        assert landing.load_table(spark, f"{name}.states", STATE).count() == 1 and landing.load_table(spark, f"{name}.nothing", STATE).count() == 0
        asked = landing.query(spark, "SELECT * FROM IDENTIFIER(:t) WHERE icao24 = :who", t=f"{name}.states", who="a' OR 'a' = 'a")
        assert asked.count() == 0  # a value, never a part of the statement
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_one_report_holds_its_parts(spark, tmp_path):
    a, b = spark.createDataFrame([(2, "x"), (1, "y")], "n int, w string"), spark.createDataFrame([], "n int")
    got = landing.one_report({"a": a, "b": b}).first()
    assert [tuple(r) for r in got.a] == [(1, "y"), (2, "x")] and got.b == []


def test_sketches_merge(spark):
    from noisetrack.functions import stats
    from noisetrack.operators import cube

    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 40).alias("day"), (F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    parts = df.groupBy("g", "day").agg(stats.quantile_sketch("x").alias("s"))
    got = stats.merged_quantiles(parts, "s", ["g"], {"a": 0.05, "b": 0.5, "c": 0.95}).collect()
    values = {g: sorted(r.x for r in df.where(F.col("g") == g).select("x").collect()) for g in range(3)}
    for r in got:
        assert r.n == len(values[r.g])
        for q, v in ((0.05, r.a), (0.5, r.b), (0.95, r.c)):
            assert abs(sum(x <= v for x in values[r.g]) / r.n - q) <= stats.SKETCH_RANK_ERROR
    counts = cube.distinct_cube(cube.distinct_parts(df.withColumn("x", F.col("x").cast("string")), ["g", "day"], "x"), ["g", "day"]).collect()
    exact = {(r.g, r.day): r.n for r in df.cube("g", "day").agg(F.countDistinct("x").alias("n")).collect()}
    assert len(counts) == len(exact) == 164 and all(abs(r.n - exact[r.g, r.day]) <= cube.DISTINCT_ERROR * exact[r.g, r.day] for r in counts)


def test_a_continuous_run_takes_what_comes(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "zone")
    rows(spark, ("a", 1000, 1.0)).write.parquet(source)
    query = jobs.ingest(jobs.read_landing(spark, source, STATE), root, str(tmp_path / "checkpoint"), every="1 second")
    try:
        query.processAllAvailable()
        assert ids(landing.read_states(spark, root)) == [("a", 1000)]
        rows(spark, ("b", 1030, 1.0)).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert ids(landing.read_states(spark, root)) == [("a", 1000), ("b", 1030)]
