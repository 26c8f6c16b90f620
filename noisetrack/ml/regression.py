"""Candidate regressors, cross-validation, comparison, intervals and transfer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noisetrack.ml import boosting, forest
from noisetrack.ml.boosting import Boosting
from noisetrack.ml.features import CATEGORICAL, NUMERIC, TARGET
from noisetrack.ml.forest import Forest
from noisetrack.session import materialised

FOLDS, MIN_ROWS, SEED = 5, 50, 42
ROWS_A_TASK, FITS_AT_ONCE, LEVEL_DB, ROWS_AT_ONCE = 50_000, 8, 0.1, 256


def preprocessing(columns: list[str]) -> list:
    """One-hot categories (an unknown one is a value of its own), numbers as they are."""
    categories = [c for c in CATEGORICAL if c in columns]
    numbers = [c for c in NUMERIC if c in columns]
    index = StringIndexer(inputCols=categories, outputCols=[f"{c}_i" for c in categories], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories])
    return [index, hot, VectorAssembler(inputCols=[*numbers, *[f"{c}_v" for c in categories]], outputCol="features", handleInvalid="skip")]


def candidate_models() -> dict:
    """The four candidates; the boosted ones are fitted together, see ``boosting``, and all folds of the forest, see ``forest``."""
    common = {"featuresCol": "features", "labelCol": TARGET}
    return {
        "linear": LinearRegression(**common),
        "forest": Forest(trees=250, depth=14, least=3, seed=SEED),
        "boosting": Boosting(rounds=300, depth=3, step=0.05, least=5, share=0.9),
        "deep_boosting": Boosting(rounds=400, depth=6, step=0.06, least=20, l2=1.0),
    }


def fold(key: Column, n: int = FOLDS) -> Column:
    """A stable fold of a row, from a hash of its key."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(digest, 16, 10).cast("long") % n).cast("int")


def split(df: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """80/20 by a hash of the key; too few rows are refused."""
    if df.limit(MIN_ROWS).count() < MIN_ROWS:
        raise ValueError(f"at least {MIN_ROWS} rows are needed")
    part = fold(F.col(key))
    return df.where(part != 0), df.where(part == 0)


def metrics(df: DataFrame, prediction: str = "prediction", target: str = TARGET) -> DataFrame:
    """One row: n, rmse, mae and r2."""
    error = F.col(prediction) - F.col(target)
    return df.agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(target) * F.count("*"))).alias("r2"),
    )


def fit(df: DataFrame, model) -> PipelineModel:
    """A model runs many jobs, so partitions are as few as rows allow."""
    return Pipeline(stages=[*preprocessing(df.columns), model.copy()]).fit(packed(df))


def packed(df: DataFrame) -> DataFrame:
    """In partitions of some ``ROWS_A_TASK`` rows."""
    return df.coalesce(max(1, -(-df.count() // ROWS_A_TASK)))


def at_once(spark: SparkSession, jobs: list[Callable]) -> list:
    """Results of independent fits, ``FITS_AT_ONCE`` of them side by side: each leaves most of the cluster idle between its
    many small jobs."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return list(pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs))


def fold_models(df: DataFrame, model, key: str = "event_id", n: int = FOLDS) -> list[Callable]:
    """For each fold a job that fits the model on the other folds and predicts the fold's rows."""
    marked = df.withColumn("fold", fold(F.col(key), n))

    def job(k: int) -> Callable:
        return lambda: fit(marked.where(F.col("fold") != k), model).transform(marked.where(F.col("fold") == k)).select(key, "fold", TARGET, "prediction")

    return [job(k) for k in range(n)]


def boosted(df: DataFrame, specs: list[Boosting], others: tuple[DataFrame, ...] = (), key: str = "event_id", n: int = FOLDS) -> list[tuple[DataFrame, ...]]:
    """For each candidate the predictions of the rows by the fit that has not seen their fold, and those of the rows, and of
    each other table, by the fit on all rows.  Categories and bins are those of all rows."""
    prepare = Pipeline(stages=preprocessing(df.columns)).fit(df)
    ready = lambda x: boosting.as_rows(prepare.transform(x.withColumn("_fold", fold(F.col(key), n))), key, TARGET, "_fold").withColumn("all", F.lit(n))
    rows = ready(df)
    models, cuts = boosting.fit_folds(rows, specs, n, rows_a_task=ROWS_A_TASK)
    keep = (key, "fold", TARGET)
    return [(boosting.predict(rows, m, cuts, keep, "fold"), *(boosting.predict(x, m, cuts, keep, "all") for x in (rows, *map(ready, others)))) for m in models]


def forested(df: DataFrame, spec: Forest, other: DataFrame | None = None, key: str = "event_id", n: int = FOLDS) -> tuple[DataFrame, ...]:
    """Predictions of the rows by the fit that has not seen their fold and, with another table, those of the rows and of the
    other's by the fit on all rows.  Categories and bins are those of all rows.  Keys are unique, in both tables together."""
    prepare = Pipeline(stages=preprocessing(df.columns)).fit(df)
    ready = lambda x, part: boosting.as_rows(prepare.transform(x.withColumn("_fold", part)), key, TARGET, "_fold")
    rows = ready(df, fold(F.col(key), n))
    if other is not None:
        rows = rows.unionByName(ready(other, F.lit(-1)))
    rows = materialised(rows, "forest-rows")
    found = materialised(forest.predictions(rows, spec, n, key, whole=other is not None), "forest")
    mine = rows.select(key, "fold", TARGET).join(found, key)
    of = lambda where, c: mine.where(where).select(key, "fold", TARGET, F.col(c).alias("prediction"))
    return (of("fold >= 0", "out_of_fold"), *((of("fold >= 0", "by_all"), of("fold < 0", "by_all")) if other is not None else ()))


def in_reach(df: DataFrame, model):
    """The model, or for a forest on a table that no task may hold, MLlib's of the same parameters."""
    return model.mllib(TARGET) if isinstance(model, Forest) and df.count() > forest.MOST_ROWS else model


def out_of_fold(df: DataFrame, model, key: str = "event_id", n: int = FOLDS) -> DataFrame:
    """Predictions of each row by the model that has not seen its fold."""
    model = in_reach(df, model)
    if isinstance(model, Forest):
        return forested(df, model, key=key, n=n)[0]
    if isinstance(model, Boosting):
        return boosted(df, [model], key=key, n=n)[0][0]
    return reduce(DataFrame.unionByName, at_once(df.sparkSession, fold_models(df, model, key, n)))


def fold_errors(predicted: DataFrame) -> DataFrame:
    """Mean and (population) standard deviation of the folds' RMSE, rounded to three digits."""
    error = F.col("prediction") - F.col(TARGET)
    by_fold = predicted.groupBy("fold").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    return by_fold.agg(F.round(F.avg("rmse"), 3).alias("cv_rmse"), F.round(F.stddev_pop("rmse"), 3).alias("cv_std"))


def cross_validated(df: DataFrame, model, n: int = FOLDS) -> DataFrame:
    return fold_errors(out_of_fold(df, model, n=n))


@dataclass
class Comparison:
    table: DataFrame
    best: str


def compare(df: DataFrame, models: dict, n: int = FOLDS) -> Comparison:
    """A row for each candidate (CV and test metrics, over-fit gap) and the one with the smallest rounded CV RMSE, the first
    on a tie."""
    train, test = split(df)

    def fitted(model) -> Callable:
        def job() -> tuple[DataFrame, ...]:
            whole = fit(train, model)
            return whole.transform(train), whole.transform(test)

        return job

    models = {name: in_reach(df, m) for name, m in models.items()}
    forests = {name: m for name, m in models.items() if isinstance(m, Forest)}
    trees = {name: m for name, m in models.items() if isinstance(m, Boosting)}
    rest = {name: m for name, m in models.items() if not isinstance(m, (Boosting, Forest))}
    jobs = [lambda: boosted(train, list(trees.values()), (test,), n=n)] if trees else []
    jobs += [lambda m=m: forested(train, m, test, n=n) for m in forests.values()]
    for model in rest.values():
        jobs += [fitted(model), *fold_models(train, model, n=n)]
    done, out = at_once(df.sparkSession, jobs), None
    results = dict(zip(trees, done[0], strict=True)) if trees else {}
    results |= dict(zip(forests, done[bool(trees) :]))
    for k, name in enumerate(rest):
        (on_train, on_test), *folds = done[len(jobs) - (len(rest) - k) * (n + 1) :][: n + 1]
        results[name] = (reduce(DataFrame.unionByName, folds), on_train, on_test)
    for order, name in enumerate(models):
        folds, on_train, on_test = results[name]
        on_test = metrics(on_test).selectExpr("rmse as test_rmse", "mae as test_mae", "r2 as test_r2", "1 as k")
        on_train = metrics(on_train).selectExpr("rmse as train_rmse", "1 as k")
        one = fold_errors(folds).withColumn("k", F.lit(1)).join(on_test, "k").join(on_train, "k").drop("k")
        one = one.select(F.lit(name).alias("model"), F.lit(order).alias("place"), "*", (F.col("test_rmse") - F.col("train_rmse")).alias("overfit_gap"))
        out = one if out is None else out.unionByName(one)
    rows = out.collect()  # a row for each candidate
    best = min(rows, key=lambda r: (r["cv_rmse"], r["place"]))["model"]
    return Comparison(df.sparkSession.createDataFrame(rows, out.schema), best)


def predict_with_interval(train: DataFrame, rows: DataFrame, key: str = "event_id", trees: int = 100, depth: int = 6, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Prediction and interval by a quantile regression forest; MLlib has no quantile loss.

    A training row weighs, for a row to predict, the mean over the trees of one by the size of the leaf that both fall into,
    or nothing.  The bounds are quantiles of the training levels under these weights: pooled over the trees, one quantile of
    all; where the prediction (a mean, which a few high levels in a leaf can lift above the upper quantile) lies outside, the
    bound is moved to it, so that lower <= prediction <= upper.  Levels are counted by leaf in steps of ``LEVEL_DB``, so that a leaf has no more entries than there are steps,
    however many rows fall into it: these counts are the model, which each task gets whole (``trees`` times 2 ** ``depth`` leaves
    at most), and a row's weights are added up where the row is."""
    forest = RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=SEED, featuresCol="features", labelCol=TARGET, leafCol="leaves")
    model = fit(train, forest)
    leaves = model.transform(train).select(F.round(F.col(TARGET) / LEVEL_DB).cast("int").alias("step"), F.posexplode(vector_to_array("leaves")).alias("tree", "leaf"))
    counts = leaves.where("step IS NOT NULL").groupBy("tree", F.col("leaf").cast("int").alias("leaf"), "step").agg(F.count("*").alias("n")).toArrow()
    tree, leaf, step, n = (counts[c].to_numpy() for c in ("tree", "leaf", "step", "n"))
    first, width = int(step.min()), int(leaf.max()) + 1
    known, at = np.unique(tree * width + leaf, return_inverse=True)
    weight = np.zeros((len(known), int(step.max()) - first + 1))
    weight[at, step - first] = n
    weight = np.cumsum(weight, axis=1) / weight.sum(axis=1, keepdims=True) / trees
    shared = rows.sparkSession.sparkContext.broadcast((known, weight))

    def bounds(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        for batch in it:
            place = np.searchsorted(known, np.array(batch["leaves"].flatten().to_numpy(), dtype=np.int64).reshape(len(batch), trees) + np.arange(trees) * width)
            found = np.empty((2, len(batch)))
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = place[start : start + ROWS_AT_ONCE]
                upto = np.zeros((len(part), weight.shape[1]))
                for t in range(trees):
                    upto += weight[part[:, t]]
                for k, q in enumerate((low, high)):
                    found[k, start : start + len(part)] = (first + np.argmax(upto >= q - 1e-9, axis=1)) * LEVEL_DB
            prediction = batch["prediction"].to_numpy()
            lower, upper = np.minimum(found[0], prediction), np.maximum(found[1], prediction)
            yield pa.RecordBatch.from_arrays([batch[key], batch[TARGET], batch["prediction"], pa.array(lower), pa.array(upper)], names=[key, TARGET, "prediction", "lower", "upper"])

    mine = model.transform(rows).select(key, TARGET, "prediction", vector_to_array("leaves").alias("leaves"))
    kinds = dict(mine.dtypes)
    return mine.mapInArrow(bounds, f"{key} {kinds[key]}, {TARGET} {kinds[TARGET]}, prediction double, lower double, upper double")
