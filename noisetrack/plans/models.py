"""Registered queries on regression: the four candidates of ``ml.regression`` as they are, in five folds."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from noisetrack.ml import regression
from noisetrack.ml.features import TARGET
from noisetrack.plans import core
from noisetrack.plans.core import query
from noisetrack.plans.views import with_views
from noisetrack.session import materialised, scratch

_NUMBERS = ("hour", "is_night", "is_weekend", "num_aircraft", "num_close_aircraft", "avg_altitude_m", "min_distance_km")
_HOT = ("hot_0", "hot_1", "hot_2")


def table(spark, sf_dir):
    """The enriched noise table with numbers for all features, stored once."""
    rows = core.enriched(spark, sf_dir).select("event_id", "hour", "is_night", "is_weekend", "airport", "num_aircraft", "num_close_aircraft", "avg_altitude_m", "min_distance_km", TARGET)
    return materialised(rows, "training")


@query(
    core.on_enriched(
        f"SELECT event_id, {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in _NUMBERS)}, {', '.join(f'CASE WHEN place = {k} THEN 1e0 ELSE 0e0 END AS {c}' for k, c in enumerate(_HOT))}"
        " FROM enriched JOIN (SELECT airport, row_number() OVER (ORDER BY count(*) DESC, airport) - 1 AS place FROM enriched GROUP BY airport) USING (airport)"
    )
)
def ml_features(spark, sf_dir):
    """The entries of each row's vector: numbers, then one for each airport, the most frequent first."""
    rows = table(spark, sf_dir)
    out = Pipeline(stages=regression.preprocessing(rows.columns)).fit(rows).transform(rows).select("event_id", vector_to_array("features").alias("v"))
    return core.rounded(out.select("event_id", *[F.col("v")[k].alias(c) for k, c in enumerate((*_NUMBERS, *_HOT))]))


@query()
def ml_compare(spark, sf_dir):
    found = regression.compare(table(spark, sf_dir), regression.candidate_models())
    return found.table.withColumn("chosen", F.col("model") == found.best)


@query(with_views("SELECT event_id, CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM noise", noise_=True))
def ml_split(spark, sf_dir):
    train, test = regression.split(core.noise(spark, sf_dir))
    return train.select("event_id", F.lit("train").alias("part")).unionByName(test.select("event_id", F.lit("test").alias("part")))


@query(with_views("SELECT count(*) AS n, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae, round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 6) AS r2 FROM (SELECT laeq_db AS y, CAST(40 + event_id % 50 AS DOUBLE) AS p FROM noise)", noise_=True))
def regression_metrics(spark, sf_dir):
    rows = core.noise(spark, sf_dir).select(TARGET, F.expr("cast(40 + event_id % 50 as double)").alias("prediction"))
    return core.rounded(regression.metrics(rows))


@query()
def ml_interval(spark, sf_dir):
    train, test = regression.split(table(spark, sf_dir))
    return regression.predict_with_interval(train, test)


@query()
def ml_persist(spark, sf_dir):
    """Saved, loaded, and the same predictions."""
    rows, path = table(spark, sf_dir), scratch(spark, "model")
    model = regression.fit(rows, regression.candidate_models()["linear"])
    model.write().overwrite().save(path)
    a = model.transform(rows).select("event_id", F.col("prediction").alias("p"))
    b = PipelineModel.load(path).transform(rows).select("event_id", F.col("prediction").alias("q"))
    return a.join(b, "event_id").select("event_id", (F.abs(F.col("p") - F.col("q")) < 1e-9).alias("same"))


@query()
def ml_oof(spark, sf_dir):
    return regression.out_of_fold(table(spark, sf_dir), regression.candidate_models()["forest"])


@query()
def ml_transfer(spark, sf_dir):
    """A model of one airport scored on the others."""
    rows = table(spark, sf_dir)
    model = regression.fit(rows.where("airport = 'CDG'"), regression.candidate_models()["linear"])
    return regression.metrics(model.transform(rows.where("airport <> 'CDG'")))
