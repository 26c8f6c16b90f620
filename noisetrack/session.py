"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "noisetrack", **conf: str) -> SparkSession:
    """A session with the settings that the operators' semantics rely on: UTC, ANSI mode, adaptive execution."""
    builder = SparkSession.builder.appName(app)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return builder.config(map=defaults | conf).getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in this application's part of the cluster's checkpoint folder, which Hadoop deletes when the driver ends; a
    local session without a checkpoint folder (tests) gets a folder of its own, which a cluster's executors would not see."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        root = context.getCheckpointDir()
    home = f"{root.rstrip('/')}/noisetrack-{context.applicationId}"
    if home not in _HOMES:
        place = spark._jvm.org.apache.hadoop.fs.Path(home)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(place)
        fs.deleteOnExit(place)
        _HOMES.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex}"


_HOMES: set[str] = set()


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Written once and read again, for an intermediate table that several queries use."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
