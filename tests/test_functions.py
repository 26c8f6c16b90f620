import math
import random

import pytest
from pyspark.sql import functions as F

from noisetrack.functions import acoustic, geo, stats, times


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def lit(*values):
    return [F.lit(float(v)) for v in values]


def test_chord_equals_haversine(spark):
    """At the same place, very near, over the antimeridian, at a pole and far away; a null stays one."""
    rows = [(48.7, 2.2, 48.7, 2.2), (48.7, 2.2, 48.7000001, 2.2), (48.7, 2.2, 48.88, 2.2), (0.0, 179.99, 0.0, -179.99), (89.95, 10.0, 89.95, -170.0), (-60.0, 5.0, 20.0, 40.0), (1.0, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    chord = geo.chord_km(geo.squared_chord(geo.unit_vector(F.col("a"), F.col("b")), geo.unit_vector(F.col("c"), F.col("d"))))
    for r in df.select(chord.alias("x"), geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("y")).collect():
        assert (r.x is None) == (r.y is None) and (r.x is None or abs(r.x - r.y) < 1e-8)


def test_haversine_known_distance(spark):
    r = one(spark, km=geo.haversine_km(*lit(48.8566, 2.3522, 49.0097, 2.5479)), m=geo.haversine_m(*lit(48.8566, 2.3522, 49.0097, 2.5479)))
    assert 20 < r.km < 26 and r.m == pytest.approx(r.km * 1000)


def test_null_coordinates_stay_null(spark):
    nothing = F.lit(None).cast("double")
    r = one(spark, km=geo.haversine_km(F.lit(1.0), F.lit(1.0), nothing, F.lit(1.0)), e=geo.elevation_deg(nothing, F.lit(10.0)), a=acoustic.received_db(F.lit(130.0), nothing))
    assert r.km is None and r.e is None and r.a is None


def test_bearings_and_angles(spark):
    r = one(spark, n=geo.bearing_deg(*lit(48, 2, 49, 2)), e=geo.bearing_deg(*lit(0, 2, 0, 3)), d=geo.ang_diff(*lit(350, 10)), o=geo.ang_diff(*lit(0, 180)))
    assert r.n == pytest.approx(0, abs=0.5) and r.e == pytest.approx(90, abs=0.5) and r.d == 20 and r.o == 180


def test_slant_overhead(spark):
    assert one(spark, s=geo.slant_km(F.lit(0.0), F.lit(1000.0)), n=geo.slant_km(F.lit(3.0), F.lit(-50.0))) == (1.0, 3.0)


def test_dead_reckoning_agrees_for_short_ways(spark):
    a, b = geo.advance(*lit(48.9, 2.4, 77, 900)), geo.move(*lit(48.9, 2.4, 77, 900))
    r = one(spark, a=a[0], b=a[1], c=b[0], d=b[1])
    assert r.a == pytest.approx(r.c, abs=1e-5) and r.b == pytest.approx(r.d, abs=1e-5)


def test_energy_sum(spark):
    df = spark.createDataFrame([(60.0,), (60.0,)], "l double")
    assert df.agg(acoustic.energy_sum_db(F.col("l"), 0.0)).first()[0] == pytest.approx(63.01, abs=0.01)
    assert df.where("l > 99").agg(acoustic.energy_sum_db(F.col("l"), 44.0)).first()[0] == pytest.approx(44.0)


@pytest.mark.parametrize("text,good", [("2026-06-15T10:00:00.400000+0000", True), ("2026-06-15T10:00:00Z", True), ("2026-06-15T10:00:00+00:00", True), ("2026-06-15T10:00:00", True), (None, False), ("soon", False), ("", False)])
def test_parse_iso(spark, text, good):
    t = one(spark, t=F.unix_seconds(times.parse_iso(F.lit(text).cast("string")))).t
    assert (t == 1781517600) if good else t is None


def test_day_windows_are_cut_at_the_end_of_the_day_only(spark):
    w = times.windows_of_day(F.lit("2026-06-15").cast("date"), 50, F.lit("2026-06-15 02:00:00").cast("timestamp"))
    assert len(one(spark, w=w).w) == 3  # 0:00, 0:50 and 1:40; the last is not cut at now
    full = one(spark, w=times.windows_of_day(F.lit("2026-06-15").cast("date"), 50, F.lit("2026-06-17").cast("timestamp"))).w
    assert len(full) == 29 and (full[-1].stop - full[-1].start).total_seconds() == 40 * 60
    assert [d.day for d in one(spark, d=times.days_back(F.lit("2026-06-15").cast("date"), 3)).d] == [13, 14, 15]


def test_statistics(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", 2.0, 15.0), ("a", 9.0, 90.0), ("b", 1.0, 1.0), ("c", 1.0, 5.0), ("c", 1.0, 6.0), ("c", 1.0, 7.0)], "g string, x double, y double")
    found = {r.g: r for r in stats.spearman(df, "x", "y", ["g"]).collect()}
    assert found["a"].rho == pytest.approx(0.9486833) and "b" not in found and found["c"].rho is None
    assert stats.quantiles(df.where("g = 'a'"), "y", [], {"m": 0.5}, interpolate=False).first().m == 20.0
    # The same where values are dealt to ranges.
    rnd = random.Random(4)
    wide = spark.createDataFrame([(f"g{i % 2}", float(rnd.randint(0, 150)), rnd.gauss(0, 1)) for i in range(900)], "g string, x double, y double")
    plain = {r.g: r for r in stats.spearman(wide, "x", "y", ["g"]).collect()}, sorted(stats.quantiles(wide, "x", ["g"], {"a": 0.1, "b": 0.5}).collect())
    monkeypatch.setattr(stats, "ONE_TASK", 10)
    assert ({r.g: r for r in stats.spearman(wide, "x", "y", ["g"]).collect()}, sorted(stats.quantiles(wide, "x", ["g"], {"a": 0.1, "b": 0.5}).collect())) == plain
    assert [(r.g, r.a, r.b) for r in plain[1]] == [tuple(r) for r in wide.groupBy("g").agg(F.percentile("x", 0.1), F.percentile("x", 0.5)).orderBy("g").collect()]
    # Student's t with 10 degrees of freedom: 2.228 is the two-sided 5 % point
    t = 2.228139
    r = t / math.sqrt(10 + t * t)
    assert stats.beta_inc(5, 0.5, 1 - r * r) == pytest.approx(0.05, abs=1e-5)
