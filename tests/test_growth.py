"""Queries over events repeated with shifted keys: the pairs that their joins give grow no faster than the events."""

import re

import pytest

from noisetrack.plans import registry
from noisetrack.streaming import jobs

SF = "/root/testdata/sf0.001"
COPIES = (12, 36)
#: One query for each shared step: the search for the nearest, the gate, the sums around stations.
QUERIES = ("corr_pearson", "gate_status", "spatio_temporal_join")


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    folders = []
    for n in COPIES:
        folders.append(str(tmp_path_factory.mktemp(f"copies-{n}")))
        rows = spark.read.parquet(f"{SF}/events.parquet").crossJoin(spark.range(n).withColumnRenamed("id", "k"))
        rows = rows.selectExpr("event_id + k * 1000000 AS event_id", "ts", "user_id + k * 100000 AS user_id", "event_type", "value", "props")
        rows.write.parquet(f"{folders[-1]}/events.parquet")
    return folders


def joined(spark, run):
    """Rows that the joins of all executions in ``run`` give."""
    store = spark._jsparkSession.sharedState().statusStore()
    each = lambda seq: iter(lambda i=seq.iterator(): i.next() if i.hasNext() else None, None)
    known = lambda: {x.executionId() for x in each(store.executionsList())}
    before = known()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    total = 0
    for execution in known() - before:
        values = {pair._1(): pair._2() for pair in each(store.executionMetrics(execution))}
        for node in each(store.planGraph(execution).allNodes()):
            if re.search("Join|Cartesian", node.name()):
                total += sum(int(values.get(m.accumulatorId(), "0").replace(",", "")) for m in each(node.metrics()) if m.name() == "number of output rows")
    return total


@pytest.mark.parametrize("name", QUERIES)
def test_pairs_grow_no_faster_than_events(spark, repeated, name):
    few, many = (joined(spark, lambda: registry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()) for folder in repeated)
    assert 0 < few < many < 1.25 * COPIES[1] / COPIES[0] * few


def test_the_live_interval_join_meets_lists(spark, repeated):
    """What the join itself gives does not grow with the square of the density; its lists are unfolded after it."""
    few, many = (joined(spark, lambda: registry.queries()["stream_interval_join"](spark, folder).write.format("noop").mode("overwrite").save()) for folder in repeated)
    assert 0 < few <= many < 1.25 * COPIES[1] / COPIES[0] * few


def test_lists_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(jobs, "TOGETHER", 3)
    monkeypatch.setattr(jobs, "GATHERED", 20)
    rows = spark.createDataFrame([(k % 7 * 9 - 20, f"a{k}") for k in range(60)] + [(None, "no time")], "snapshot_ts long, icao24 string").coalesce(1)
    got = jobs.in_lists(rows, "snapshot_ts", 15, "x").collect()
    assert all(len(r.x) <= 3 and len({s.snapshot_ts // 15 for s in r.x}) == 1 and r._last == max(s.snapshot_ts for s in r.x) for r in got)
    assert sorted(tuple(s) for r in got for s in r.x) == sorted(tuple(r) for r in rows.where("snapshot_ts IS NOT NULL").collect())
