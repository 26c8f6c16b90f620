"""What a task holds of joins whose result is all pairs near in time: run in a session of their own with little memory."""

import subprocess
import sys
from pathlib import Path

import pytest

START = """
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1]").config(map={"spark.driver.memory": "600m", "spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC"}).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
from noisetrack.operators import joins
from noisetrack.streaming import jobs
def done(df):
    df.write.format("noop").mode("overwrite").save()
    print("whole")
"""
DENSE = """
events = spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") % 1 + 1000).alias("t"), (F.col("id") % 1 + 1000.0).alias("max_ts_unix"))
states = spark.range(20000).select(F.col("id").cast("string").alias("icao24"), (F.col("id") % 1 + 990).alias("snapshot_ts"), *[F.lit(1.0).alias(c) for c in joins.STATE_COLUMNS[:6]], F.lit("AF").alias("callsign"))
"""
RUNS = {
    "interval_join": DENSE + 'done(joins.interval_pairs(events.select("event_id", "t"), states.select("icao24", "snapshot_ts"), "t", "snapshot_ts", 45))',
    "estimate_position": DENSE + 'found = joins.candidates(joins.asking_together(events), states, 45.0, keep=("_asking",), lists=True)\ndone(joins.each_asker(joins.estimate_position(found).select("_asking", "event_id", "icao24", "lat", "lon", "alt", "bracketed")))',
    "stream_interval_join": 'lists = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: F.struct(F.lit(1000).cast("long").alias("t"), i.cast("long").alias("event_id"))).alias("_events"), F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: F.struct(F.lit(990).cast("long").alias("snapshot_ts"), i.cast("string").alias("icao24"))).alias("_states")).repartition(1)\ndone(jobs.unfolded(lists, 45))',
}


@pytest.mark.parametrize("name", RUNS)
def test_pairs_are_never_held_together(name):
    """Some 20 million pairs of one time, of which a task is to hold a few only."""
    got = subprocess.run([sys.executable, "-c", START + RUNS[name]], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert got.stdout.endswith("whole\n"), got.stderr[-2000:]
