"""Models against what their definitions give row by row."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from noisetrack.ml import boosting, forest, regression
from noisetrack.ml.boosting import Boosting
from noisetrack.ml.features import TARGET
from noisetrack.ml.forest import Forest


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        hour, n = rnd.randint(0, 23), rnd.randint(0, 9)
        rows.append((i, hour, int(hour < 6), rnd.choice(["CDG", "ORY", "LBG"]), n, 45 + 2.0 * n + 0.1 * hour + rnd.gauss(0, 1.5)))
    return spark.createDataFrame(rows, f"event_id long, hour int, is_night int, airport string, num_aircraft long, {TARGET} double").cache()


def test_candidates_are_compared_by_their_folds(table):
    small = {"linear": LinearRegression(featuresCol="features", labelCol=TARGET), "forest": RandomForestRegressor(numTrees=5, maxDepth=3, seed=1, featuresCol="features", labelCol=TARGET)}
    found = regression.compare(table, small, n=3)
    rows = {r.model: r for r in found.table.collect()}
    assert set(rows) == set(small) and found.best == min(rows.values(), key=lambda r: (r.cv_rmse, r.place)).model == "linear"
    train, test = regression.split(table)
    for name, model in small.items():
        errors = {}
        for r in regression.out_of_fold(train, model, n=3).collect():
            errors.setdefault(r.fold, []).append((r.prediction - r[TARGET]) ** 2)
        per_fold = [(sum(e) / len(e)) ** 0.5 for e in errors.values()]
        mean = sum(per_fold) / 3
        assert len(per_fold) == 3 and sum(map(len, errors.values())) == train.count()
        assert rows[name].cv_rmse == pytest.approx(mean, abs=6e-4) and rows[name].cv_std == pytest.approx((sum((x - mean) ** 2 for x in per_fold) / 3) ** 0.5, abs=6e-4)
        held = regression.fit(train, model).transform(test).collect()
        assert rows[name].test_rmse == pytest.approx((sum((r.prediction - r[TARGET]) ** 2 for r in held) / len(held)) ** 0.5)
    assert set(regression.candidate_models()) == {"linear", "forest", "boosting", "deep_boosting"}


def test_interval_is_one_quantile_of_pooled_weights(table):
    train, test = regression.split(table)
    got = {r.event_id: r for r in regression.predict_with_interval(train, test, trees=10, depth=4).collect()}
    forest = RandomForestRegressor(numTrees=10, maxDepth=4, minInstancesPerNode=5, seed=regression.SEED, featuresCol="features", labelCol=TARGET, leafCol="leaves")
    model = regression.fit(train, forest)
    leaves = lambda df: [(r.event_id, r[TARGET], list(r.l)) for r in model.transform(df).select("event_id", TARGET, vector_to_array("leaves").alias("l")).collect()]
    known = leaves(train)
    for event, _, mine in leaves(test)[:40]:
        weights = [0.0] * len(known)
        for t, leaf in enumerate(mine):
            inside = [k for k, x in enumerate(known) if x[2][t] == leaf]
            for k in inside:
                weights[k] += 1 / len(inside) / 10
        order = sorted((x[1], w) for x, w in zip(known, weights, strict=True))

        def quantile(q, order=order):
            total = 0.0
            for y, w in order:
                total += w
                if total >= q - 1e-9:
                    return y

        assert got[event].lower == pytest.approx(quantile(0.1), abs=regression.LEVEL_DB) and got[event].upper == pytest.approx(quantile(0.9), abs=regression.LEVEL_DB)
    inside = [r.lower <= r[TARGET] <= r.upper for r in got.values()]
    assert len(inside) == test.count() and 0.65 <= sum(inside) / len(inside) <= 0.95


def test_few_rows_are_refused(table):
    with pytest.raises(ValueError, match="at least"):
        regression.split(table.where(F.col("event_id") < 10))


def plain_boosting(x, y, uid, spec, bins):
    """Start and trees (nested tuples) of one fit, by loops over rows, features and bins."""

    def grow(rows, residual, depth):
        g, n = sum(residual[i] for i in rows), len(rows)
        best = None
        for f in range(len(x[0])):
            for b in range(bins - 1):
                left = [i for i in rows if x[i][f] <= b]
                if spec.least <= len(left) <= n - spec.least and 0 < len(left) < n:
                    lg = sum(residual[i] for i in left)
                    worth = lg**2 / (len(left) + spec.l2) + (g - lg) ** 2 / (n - len(left) + spec.l2)
                    if best is None or worth > best[0] + 1e-9:
                        best = (worth, f, b)
        if not depth or best is None or best[0] - g**2 / (n + spec.l2) <= 1e-9 * (1 + g * g):
            return spec.step * g / (n + spec.l2) if n else 0.0
        _, f, b = best
        return f, b, grow([i for i in rows if x[i][f] <= b], residual, depth - 1), grow([i for i in rows if x[i][f] > b], residual, depth - 1)

    start = sum(y) / len(y)
    predicted, trees = [start] * len(y), []
    for r in range(spec.rounds):
        use = boosting.drawn(np.array(uid), r, spec.share)
        tree = grow([i for i in range(len(y)) if use[i]], [a - b for a, b in zip(y, predicted, strict=True)], spec.depth)
        trees.append(tree)
        predicted = [p + value(tree, row) for p, row in zip(predicted, x, strict=True)]
    return start, trees


def value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


SPECS = [Boosting(rounds=13, depth=3, step=0.2, least=4, share=0.8), Boosting(rounds=6, depth=4, step=0.3, least=9, l2=1.0)]


@pytest.mark.parametrize("rows_a_task", [50_000, 120])
def test_boosting_equals_a_plain_one(table, rows_a_task):
    bins, folds = 8, 3
    features = F.array(*[F.col(c).cast("double") for c in ("hour", "is_night", "num_aircraft")])
    rows = table.select("event_id", features.alias("x"), F.col(TARGET).alias("y"), regression.fold(F.col("event_id"), folds).alias("fold"), F.xxhash64("event_id").alias("uid")).withColumn("all", F.lit(folds))
    models, cuts = boosting.fit_folds(rows, SPECS, folds, bins, rows_a_task)
    known = rows.collect()
    x = boosting.binned(np.array([r.x for r in known]), cuts).tolist()
    for spec, model in zip(SPECS, models, strict=True):
        for column in ("fold", "all"):
            got = {r.event_id: r.prediction for r in boosting.predict(rows, model, cuts, ("event_id",), column).collect()}
            for k in range(folds) if column == "fold" else [folds]:
                own = [i for i, r in enumerate(known) if r.fold != k]
                start, trees = plain_boosting([x[i] for i in own], [known[i].y for i in own], [known[i].uid for i in own], spec, bins)
                for i, r in enumerate(known):
                    if r[column] == k:
                        assert got[r.event_id] == pytest.approx(start + sum(value(t, x[i]) for t in trees), abs=1e-6)


@pytest.mark.parametrize("rows_a_task", [50_000, 120])
def test_boosting_over_many_tasks_equals_a_plain_one(table, rows_a_task, monkeypatch):
    monkeypatch.setattr(boosting, "MOST_ROWS", 100)
    test_boosting_equals_a_plain_one(table, rows_a_task)


def test_boosting_takes_few_jobs(spark, table):
    """Beyond a task's rows it was a job for each level of each round."""
    rows = table.select(F.array(F.col("hour").cast("double"), F.col("num_aircraft").cast("double")).alias("x"), F.col(TARGET).alias("y"), regression.fold(F.col("event_id"), 3).alias("fold"), F.xxhash64("event_id").alias("uid"))
    context = spark.sparkContext
    context.setJobGroup("boosting", "all rounds")
    try:
        boosting.fit_folds(rows, SPECS, 3, 8, rows_a_task=120)
        jobs = len(context.statusTracker().getJobIdsForGroup("boosting"))
    finally:
        context._jsc.sc().clearJobGroup()
    assert jobs < 20 < SPECS[0].rounds * SPECS[0].depth


def test_packed_histograms_equal_plain_ones():
    rng = np.random.default_rng(3)
    x = np.stack([rng.choice(k, 500) for k in ([0, 1], [3, 7, 8], range(40), range(2, 34), [5])], axis=1).astype(np.uint8)
    slot, g, n = rng.integers(-1, 3, 500), rng.normal(size=500), rng.integers(0, 9, 500).astype(float)
    packed = boosting.Packed(x, 40)
    assert len(packed.packs) < x.shape[1]
    got = packed.histograms(slot, g, n, 3)
    for k, weight in enumerate((g, n)):
        for s in range(3):
            for f in range(x.shape[1]):
                assert got[k, s, f] == pytest.approx(np.bincount(x[slot == s, f], weight[slot == s], 40), abs=1e-9)


def test_boosted_candidates_are_compared(table):
    found = regression.compare(table, {"linear": LinearRegression(featuresCol="features", labelCol=TARGET), "boosting": Boosting(30, 3, 0.2, least=5)}, n=3)
    rows = {r.model: r for r in found.table.collect()}
    train, _ = regression.split(table)
    errors = {}
    for r in regression.out_of_fold(train, Boosting(30, 3, 0.2, least=5), n=3).collect():
        errors.setdefault(r.fold, []).append((r.prediction - r[TARGET]) ** 2)
    assert rows["boosting"].cv_rmse == pytest.approx(sum((sum(e) / len(e)) ** 0.5 for e in errors.values()) / 3, abs=6e-4)
    assert rows["boosting"].test_rmse < 4 and rows["boosting"].train_rmse < rows["boosting"].test_rmse


def test_boosting_has_no_splits_where_nothing_differs(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0], 5.0, i % 3, i, 3) for i in range(60)], "event_id long, x array<double>, y double, fold int, uid long, all int")
    models, cuts = boosting.fit_folds(rows, [Boosting(3, 2, 0.5)], 3)
    assert {r.prediction for r in boosting.predict(rows, models[0], cuts, ("event_id",), "fold").collect()} == {5.0}


def test_prediction_lies_inside_its_interval(spark):
    """A few very high levels lift the mean of each leaf above the upper quantile."""
    rows = [(i, i % 24, int(i % 24 < 6), "CDG", i % 3, 400.0 if i % 20 == 0 else 50.0 + i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, f"event_id long, hour int, is_night int, airport string, num_aircraft long, {TARGET} double")
    train, test = regression.split(table)
    got = regression.predict_with_interval(train, test, trees=10, depth=2).collect()
    assert len(got) == test.count() and all(r.lower <= r.prediction <= r.upper for r in got)
    assert any(r.prediction == r.upper for r in got)


def test_interval_pools_weights_without_a_shuffle(table):
    """Rows times trees times steps are never rows of a table."""
    train, test = regression.split(table)
    got = regression.predict_with_interval(train, test, trees=10, depth=4)
    assert got.count() == test.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan and "Window" not in plan


def test_a_tree_equals_a_plain_one():
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 8, (300, 3)).astype(np.uint8), rng.normal(size=300)
    y += x[:, 0] * (x[:, 1] > 3)
    w = forest.times_drawn(np.arange(300), 5, 42)
    assert 0.5 < np.mean(w > 0) < 0.75 and 0.85 < w.mean() < 1.15
    spec = Forest(1, 5, least=4, of=1.0, bins=8)

    def plain(rows, depth):
        n, g = w[rows].sum(), (w * y)[rows].sum()
        best = (0.0, None)
        for f in range(3):
            for b in range(7):
                left, right = [i for i in rows if x[i, f] <= b], [i for i in rows if x[i, f] > b]
                if w[left].sum() >= 4 and w[right].sum() >= 4:
                    gain = (w * y)[left].sum() ** 2 / w[left].sum() + (w * y)[right].sum() ** 2 / w[right].sum() - g**2 / n
                    best = max(best, (gain, (left, right, f, b)), key=lambda c: c[0])
        if not depth or best[1] is None:
            return g / n
        left, right, f, b = best[1]
        return f, b, plain(left, depth - 1), plain(right, depth - 1)

    tree = plain(list(np.flatnonzero(w)), 5)
    assert forest.grow(x, y, w, spec, rng).predict(x) == pytest.approx([value(tree, row) for row in x])


def test_forest_of_all_folds_takes_few_jobs_and_is_as_good_as_mllibs(spark, table):
    spec = Forest(60, 8, least=3, groups=4)
    context = spark.sparkContext
    context.setJobGroup("forest", "all folds")
    try:
        got = regression.out_of_fold(table, spec).collect()
        jobs = len(context.statusTracker().getJobIdsForGroup("forest"))
    finally:
        context._jsc.sc().clearJobGroup()
    assert jobs < 40  # a job for each level and group of nodes of each fold before
    assert len(got) == len({r.event_id for r in got}) == 400
    error = lambda rows: (sum((r.prediction - r[TARGET]) ** 2 for r in rows) / len(rows)) ** 0.5
    assert error(got) == pytest.approx(error(regression.out_of_fold(table, spec.mllib(TARGET)).collect()), rel=0.1)
    again = {r.event_id: r.prediction for r in regression.out_of_fold(table.repartition(3), spec).collect()}
    assert all(again[r.event_id] == pytest.approx(r.prediction) for r in got)


def test_a_tree_of_sums_equals_one_of_rows():
    rng = np.random.default_rng(5)
    known = np.unique(rng.integers(0, 6, (60, 3)).astype(np.uint8), axis=0)
    at = rng.integers(0, len(known), 2000)
    y = rng.normal(size=2000) + known[at, 0] * (known[at, 1] > 2)
    w = forest.times_drawn(np.arange(2000), 1, 42)
    spec = Forest(1, 6, least=5, of=1.0, bins=6)
    of_rows = forest.grow(known[at], y, w, spec, np.random.default_rng(1)).predict(known)
    of_sums = forest.grow_sums(known, np.bincount(at, w), np.bincount(at, w * y), spec, np.random.default_rng(1)).predict(known)
    assert of_sums == pytest.approx(of_rows)


def test_forest_does_not_depend_on_parts(table, monkeypatch):
    spec = Forest(20, 6, least=3, groups=3)
    whole = {r.event_id: r.prediction for r in regression.out_of_fold(table, spec).collect()}
    few = table.withColumn("hour", F.lit(3)).withColumn("num_aircraft", F.col("num_aircraft") % 2)  # vectors with many rows
    of_few = {r.event_id: r.prediction for r in regression.out_of_fold(few, spec).collect()}
    monkeypatch.setattr(forest, "ROWS_A_TASK", 50)
    assert {r.event_id: r.prediction for r in regression.out_of_fold(table, spec).collect()} == pytest.approx(whole)
    assert {r.event_id: r.prediction for r in regression.out_of_fold(few, spec).collect()} == pytest.approx(of_few, rel=1e-3)


def test_forest_sends_sums_and_not_rows_to_its_tasks(spark, table):
    """Each group of trees got all rows, and sent back as many."""
    rows = table.withColumn("hour", F.col("hour") % 4).crossJoin(spark.range(10)).withColumn("event_id", F.col("event_id") * 10 + F.col("id")).drop("id").cache()
    n, store = rows.count(), spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        gateway = spark.sparkContext._gateway
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in (stages.apply(k) for k in range(stages.size()))}

    before = shuffled()
    assert regression.out_of_fold(rows, Forest(40, 6, least=3, groups=20)).count() == n
    assert 0 < sum(v for k, v in shuffled().items() if k not in before) < 8 * n < 2 * 20 * n


def test_forest_is_compared(table):
    found = regression.compare(table, {"linear": LinearRegression(featuresCol="features", labelCol=TARGET), "forest": Forest(20, 6, least=3, groups=2)}, n=3)
    rows = {r.model: r for r in found.table.collect()}
    train, _ = regression.split(table)
    errors = {}
    for r in regression.out_of_fold(train, Forest(20, 6, least=3, groups=2), n=3).collect():
        errors.setdefault(r.fold, []).append((r.prediction - r[TARGET]) ** 2)
    assert rows["forest"].cv_rmse == pytest.approx(sum((sum(e) / len(e)) ** 0.5 for e in errors.values()) / 3, abs=6e-4)
    assert rows["forest"].train_rmse < rows["forest"].test_rmse < 4


def test_a_table_that_no_task_may_hold_is_left_to_mllib(table, monkeypatch):
    monkeypatch.setattr(forest, "MOST_ROWS", 100)
    assert isinstance(regression.in_reach(table, Forest(5, 3)), RandomForestRegressor)
    assert regression.out_of_fold(table, Forest(5, 3), n=3).count() == 400
