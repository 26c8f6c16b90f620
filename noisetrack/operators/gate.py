"""The strict association of noise events with single aircraft, and its validation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noisetrack.functions import geo
from noisetrack.functions.stats import pearson, spearman
from noisetrack.operators.joins import (
    STATE_COLUMNS, Near, answered, askers, asof_nearest, between, candidates, each_asker, events_in_window, in_own_cell, interval_join, moments, nearest, once, pays, peak_samples, spread, tracked,
    within_latitude,
)
from noisetrack.session import materialised

PLACE_S, BRACKET_S, HORIZONTAL_KM, SLANT_KM, MARGIN_KM = 15.0, 35.0, 12.0, 10.0, 3.0


def gate_join(events: DataFrame, states: DataFrame, cells: bool | None = None) -> DataFrame:
    """Events in the states' time window with the nearest aircraft and a status: clean (near and alone), ambiguous (near),
    far, no_candidate or no_snapshot.  Events of one time and place are one question.

    cells: whether the limit in space is part of the join's key; unless stated, where it pays."""
    # Read several times below: cleaned once.
    states = materialised(states.select("icao24", *STATE_COLUMNS, "on_ground"), "gate-states")
    inside = events_in_window(events, states)
    air = states.where(~F.coalesce("on_ground", F.lit(False)) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("baro_altitude_m").isNotNull())
    limit, near_ = Near(HORIZONTAL_KM, PLACE_S), None
    track = materialised(tracked(air, BRACKET_S), "gate-tracks")
    if cells is None:
        cells = spread(air, limit) and pays(track, BRACKET_S, limit)
    if cells:
        near_ = limit
    asking = askers(inside)
    dt, gap = F.col("_t") - nearest("snapshot_ts"), F.col("z.snapshot_ts") - F.col("s.snapshot_ts")
    on_spot = F.col("_t") == F.col("s.snapshot_ts")
    bracket = (gap <= BRACKET_S) & (F.col("_t") - F.col("s.snapshot_ts") <= PLACE_S) & (F.col("z.snapshot_ts") - F.col("_t") <= PLACE_S)
    speed, heading = nearest("velocity_m_s"), nearest("heading_deg")
    method = F.when(on_spot, "snap").when(bracket, "bracket").when(F.abs(dt) > PLACE_S, None).when((speed > 0) & heading.isNotNull(), "deadreckon").otherwise("snap")
    lat2, lon2 = geo.move(nearest("latitude"), nearest("longitude"), heading, speed * dt)

    def place(field: str, reckoned):
        return F.when(F.col("method") == "bracket", between(field)).when(F.col("method") == "deadreckon", reckoned).otherwise(nearest(field))

    place_ = F.struct(place("latitude", lat2).alias("lat"), place("longitude", lon2).alias("lon"), place("baro_altitude_m", nearest("baro_altitude_m")).alias("alt"))

    def placed(left, most=None):
        """Aircraft within the limit with ``horiz`` in metres and ``slant``; no farther than ``most`` where that is not null."""
        keep = ("st_lat", "st_lon", *([most] if most else []))
        if near_:
            found = candidates(left, air, BRACKET_S, keep=keep, near=near_, track=track)
        else:
            found = candidates(moments(left, *keep[2:]), air, BRACKET_S, keep=("_asking",), track=track)
        found = found.withColumn("method", method).where(F.col("method").isNotNull())
        # inline() keeps Spark from putting the whole expression into the filter below, once for each use.
        out = found.select("event_id", "icao24", "method", "_cell", *(keep if near_ else ("_asking",)), F.inline(F.array(place_)))
        out = out.where(in_own_cell(limit)) if near_ else each_asker(out)
        out = out.where(within_latitude(F.least(F.lit(HORIZONTAL_KM), most) if most else F.lit(HORIZONTAL_KM)))
        out = once(out, horiz=geo.haversine_m(F.col("st_lat"), F.col("st_lon"), F.col("lat"), F.col("lon"))).where(F.col("horiz") / 1000 <= HORIZONTAL_KM)
        out = once(out, slant=F.sqrt(F.col("horiz") * F.col("horiz") + F.col("alt") * F.col("alt")) / 1000)
        return out.where(F.col(most).isNull() | (F.col("slant") <= F.col(most))) if most else out

    # Pairs are counted as numbers, which takes no sort.  The farther one of the nearest of two halves of the aircraft is no
    # nearer than the second nearest of all, so a second look keeps the first two and a few more.
    half = F.pmod(F.xxhash64("icao24"), F.lit(2))
    seen = placed(asking).groupBy("event_id").agg(F.count("*").alias("n_cand"), F.min(F.when(half == 0, F.col("slant"))).alias("_a"), F.min(F.when(half == 1, F.col("slant"))).alias("_b"))
    seen = materialised(seen.select("event_id", "n_cand", F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.greatest("_a", "_b")).alias("_most")), "gate-counts")
    row = F.struct(
        "slant", "icao24", (F.col("horiz") / 1000).alias("horiz"), "alt", "method",
        geo.bearing_deg(F.col("st_lat"), F.col("st_lon"), F.col("lat"), F.col("lon")).alias("bearing"), geo.elevation_deg(F.col("horiz"), F.col("alt")).alias("elevation"),
    )
    order = Window.partitionBy("event_id").orderBy("slant", "icao24")
    few = placed(asking.join(seen.select("event_id", "_most"), "event_id"), most="_most")
    ranked = few.select("event_id", row.alias("x"), F.lead("slant").over(order).alias("second_slant_km"), F.row_number().over(order).alias("_rank"))
    first = ranked.where("_rank = 1").drop("_rank").join(seen.select("event_id", "n_cand"), "event_id")
    # The callsign that the nearest aircraft showed last.
    won = first.select("event_id", F.col("x.icao24").alias("icao24")).join(asking.select("event_id", F.col("max_ts_unix").alias("_t")), "event_id")
    shown = interval_join(won, air.select("icao24", "snapshot_ts", "callsign"), "_t", "snapshot_ts", BRACKET_S, ("icao24",))
    first = first.join(shown.groupBy("event_id").agg(F.max_by("callsign", "snapshot_ts").alias("callsign")), "event_id")
    nearby = asof_nearest(asking, states, BRACKET_S).select("event_id", "gap_s")
    out = answered(inside, asking.join(nearby, "event_id").join(first, "event_id", "left"))
    near, alone = F.col("x.slant") <= SLANT_KM, F.col("second_slant_km").isNull() | (F.col("second_slant_km") - F.col("x.slant") >= MARGIN_KM)
    status = F.when(F.col("gap_s").isNull(), "no_snapshot").when(F.col("x").isNull(), "no_candidate").when(near & alone, "clean").when(near, "ambiguous").otherwise("far")
    return out.select(
        "event_id", "station", "max_laeq", "max_ts_unix", status.alias("status"), F.coalesce("n_cand", F.lit(0)).alias("n_cand"), F.col("x.icao24").alias("m_icao24"), F.col("callsign").alias("m_callsign"),
        F.col("x.horiz").alias("m_horiz_km"), F.col("x.alt").alias("m_alt_m"), F.col("x.slant").alias("m_slant_km"), F.col("x.bearing").alias("m_bearing_deg"), F.col("x.elevation").alias("m_elev_deg"),
        F.col("x.method").alias("m_method"), "second_slant_km",
    )


def status_counts(gate: DataFrame) -> DataFrame:
    return gate.groupBy("status").agg(F.count("*").alias("n"))


def gate_summary(gate: DataFrame) -> DataFrame:
    """One row: events, clean, rate in percent, Pearson and Spearman of distance and level over clean pairs, and the verdict
    with what is missing."""
    clean = gate.where("status = 'clean'")
    n = gate.agg(F.count("*").alias("n_events"), F.count_if(F.col("status") == "clean").alias("n_clean"))
    n = n.withColumn("rate_pct", F.coalesce(F.round(F.try_divide(100 * F.col("n_clean"), F.col("n_events")), 1), F.lit(0.0)))
    rho = spearman(clean.withColumn("_all", F.lit(1)), "m_slant_km", "max_laeq", ["_all"]).select(F.round("rho", 3).alias("spearman"))
    r = clean.agg(F.round(pearson("m_slant_km", "max_laeq"), 3).alias("pearson"))
    one = n.withColumn("_k", F.lit(1)).join(r.withColumn("_k", F.lit(1)), "_k").join(rho.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")
    rate, negative, enough = F.col("rate_pct") >= 40, F.coalesce(F.col("spearman") <= -0.3, F.lit(False)), F.col("n_clean") >= 20
    missing = F.concat_ws(";", F.array_compact(F.array(F.when(~rate, "rate"), F.when(~negative, "correlation"), F.when(~enough, "n"))))
    return one.withColumn("decision", F.when(rate & negative & enough, "validated").otherwise("to diagnose")).withColumn("missing", missing)


def sensitivity(gate: DataFrame, margins: tuple[float, ...] = (2.0, 3.0, 5.0), slants: tuple[float, ...] = (8.0, 10.0, 15.0)) -> DataFrame:
    """Clean pairs and rate for each pair of thresholds, in one pass: a count for each, then unpivoted."""
    gap = F.coalesce(F.col("second_slant_km") - F.col("m_slant_km"), F.lit(float("inf")))
    grid = [(m, s) for m in margins for s in slants]
    counts = [F.count_if((F.col("m_slant_km") <= s) & (gap >= m)).alias(f"c{i}") for i, (m, s) in enumerate(grid)]
    one = gate.agg(F.count("*").alias("n"), *counts)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("margin_km"), F.lit(s).alias("max_slant_km"), F.col(f"c{i}").alias("n_clean")) for i, (m, s) in enumerate(grid)]))
    return one.select("n", rows.alias("r")).select("r.*", F.coalesce(F.round(F.try_divide(100 * F.col("r.n_clean"), F.col("n")), 1), F.lit(0.0)).alias("rate_pct"))


def azimuth_check(pairs: DataFrame, events: DataFrame, samples: DataFrame, tol: float = 8.0, top: int = 20) -> DataFrame:
    """For the ``top`` loudest pairs within 12 km: measured against computed direction."""
    loud = pairs.where("slant_km <= 12").orderBy(F.desc("max_laeq"), "event_id").limit(top)
    loud = loud.join(events.select("event_id", "st_lat", "st_lon"), "event_id")
    peak = peak_samples(loud, samples, tol)
    both = loud.join(peak, "event_id")
    bearing = geo.bearing_deg(F.col("st_lat"), F.col("st_lon"), F.col("aircraft_lat"), F.col("aircraft_lon"))
    geometric = geo.elevation_deg(F.col("horiz_km") * 1000, F.greatest("altitude_m", F.lit(0.0)))
    return both.select(
        "event_id", "max_laeq", "slant_km", F.col("azimuth").alias("az_measured"), F.round(bearing, 1).alias("az_bearing"), F.round(geo.ang_diff(F.col("azimuth"), bearing), 1).alias("az_diff"),
        F.col("elevation").alias("elev_measured"), F.round(geometric, 1).alias("elev_geom"),
    )


def azimuth_summary(checked: DataFrame) -> DataFrame:
    """One row on an ``azimuth_check``: pairs with both directions, median difference, share up to 45 degrees in percent,
    counts below 30 and 45, and the median elevations."""
    both = checked.where(F.col("az_diff").isNotNull())
    diff = F.col("az_diff")
    return both.agg(
        F.count("*").alias("n"),
        F.round(F.median(diff), 1).alias("median_az_diff"),  # ``top`` rows at most
        F.round(100 * F.avg((diff <= 45).cast("double")), 0).alias("coherent_pct"),
        F.count_if(diff < 30).alias("below_30"),
        F.count_if(diff < 45).alias("below_45"),
        F.round(F.median("elev_measured"), 1).alias("median_elev_measured"),
        F.round(F.median("elev_geom"), 1).alias("median_elev_geom"),
    )


def timezone_check(events: DataFrame, states: DataFrame, n: int = 3, time: str = "max_ts_unix") -> DataFrame:
    """Evenly spaced events of the window against the nearest snapshot, however far, with times as text: an offset of hours
    shows.  The snapshots are passed over once, for the last one before and the first one after each of the ``n`` events."""
    picked = stride_sample(events_in_window(events, states), n, time).select("event_id", time).collect()  # n rows
    ts = F.col("snapshot_ts")
    ends = [(F.max(F.when(ts <= r[time], ts)).alias(f"b{k}"), F.min(F.when(ts >= r[time], ts)).alias(f"a{k}")) for k, r in enumerate(picked)]
    bounds = states.agg(F.count("*"), *[c for pair in ends for c in pair])
    row = lambda k, r: F.struct(F.lit(r["event_id"]).alias("event_id"), F.lit(r[time]).alias("t"), F.col(f"b{k}").alias("b"), F.col(f"a{k}").alias("a"))
    none = F.from_json(F.lit("[]"), "array<struct<event_id:long,t:double,b:long,a:long>>")
    rows = bounds.select(F.inline(F.array(*[row(k, r) for k, r in enumerate(picked)]) if picked else none))
    near = F.when(F.col("a").isNull() | (F.col("t") - F.col("b") <= F.col("a") - F.col("t")), F.col("b")).otherwise(F.col("a"))
    clock = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss")
    near = rows.select("event_id", F.col("t").alias("max_ts_unix"), near.alias("snapshot_ts"))
    return near.select("event_id", "max_ts_unix", clock(F.col("max_ts_unix")).alias("event_utc"), "snapshot_ts", clock(F.col("snapshot_ts")).alias("snapshot_utc"), F.round(F.abs(F.col("snapshot_ts") - F.col("max_ts_unix")), 1).alias("gap_s"))


def stride_sample(events: DataFrame, n: int, time: str = "max_ts_unix") -> DataFrame:
    """Every (rows // n)-th row in order of time (event_id on a tie), ``n`` in all.  Keys are dealt to ranges of about equal
    numbers of rows; places in the order come from the ranges' counts, and only ranges that hold a wanted row are sorted."""
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = materialised(events.select("event_id", time).repartitionByRange(parts, time, "event_id").withColumn("_p", F.spark_partition_id()), "stride")
    counts = {r["_p"]: r["c"] for r in keys.groupBy("_p").agg(F.count("*").alias("c")).collect()}  # a row a range
    rows = sum(counts.values())
    if not rows:
        return events.limit(0)
    wanted = list(range(0, rows, max(1, rows // n)))[:n]
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p] = total
        total += counts[p]
    held = [p for p in starts if any(starts[p] <= w < starts[p] + counts[p] for w in wanted)]
    offset = F.element_at(F.create_map(*[F.lit(x) for p in held for x in (p, starts[p])]), F.col("_p"))
    ranked = keys.where(F.col("_p").isin(held)).withColumn("_at", offset + F.row_number().over(Window.partitionBy("_p").orderBy(time, "event_id")) - 1)
    return events.join(F.broadcast(ranked.where(F.col("_at").isin(wanted)).select("event_id")), "event_id", "left_semi")  # n rows
