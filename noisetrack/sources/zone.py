"""Landing zones that are written in batches and read as one table.

A batch goes into a folder of its own, which is never written to again, and counts once its manifest is there: a row for each
unit (a snapshot, or a station's day) that the batch replaces, renamed into place as a whole.  Readers take each unit from
the latest batch that has it.  So a write never reads or touches what it replaces, one that dies leaves the table as it was,
and running it again gives the same.  Rows are dealt to files by size, a large hour or station to several.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Zone:
    """by: the columns that files are partitioned by, as SQL on a row; unit: what a batch replaces as a whole, as DDL; schema:
    of an empty zone, without ``by``."""

    by: dict[str, str]
    unit: str
    schema: str

    @property
    def units(self) -> list[str]:
        return [x.split()[0] for x in self.unit.split(", ")]

    def parted(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.expr(sql) for name, sql in self.by.items()})


@dataclass(frozen=True)
class Written:
    batch: str | None
    rows: int
    bytes: int


def place(spark: SparkSession, path: str):
    """Hadoop's file system and path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = place(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = place(spark, path)
    fs.delete(p, True)


def files_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the data files below a folder."""
    fs, p = place(spark, path)
    n = size = 0
    found = fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        below = f.getPath().toString().split(p.getName() + "/")[-1]
        if not any(x.startswith(("_", ".")) for x in below.split("/")):
            n, size = n + 1, size + f.getLen()
    return n, size


def _manifests(spark: SparkSession, root: str, zone: Zone) -> DataFrame | None:
    if not exists(spark, f"{root}/manifests"):
        return None
    return spark.read.schema(f"seq long, batch string, bytes long, rows long, {zone.unit}").json(f"{root}/manifests/*")


def _next_seq(spark: SparkSession, root: str) -> int:
    if not exists(spark, f"{root}/manifests"):
        return 1
    fs, p = place(spark, f"{root}/manifests")
    return 1 + max((int(f.getPath().getName().split("-")[0]) for f in fs.listStatus(p)), default=0)


def write_batch(df: DataFrame, root: str, zone: Zone) -> Written:
    """The rows as a batch; its units replace those of the same name.  No rows, no batch.  One writer at a time."""
    spark, batch = df.sparkSession, uuid.uuid4().hex
    target = f"{root}/batches/batch={batch}"
    zone.parted(df).hint("rebalance", *zone.by).write.partitionBy(*zone.by).parquet(target)
    n_files, size = files_of(spark, target)
    if not n_files:
        delete(spark, target)
        return Written(None, 0, 0)
    # The units are read from the files that were written: the rows are not computed twice.
    units = spark.read.option("basePath", target).parquet(target).groupBy(*zone.units).agg(F.count("*").alias("rows"))
    seq = _next_seq(spark, root)
    rows = units.withColumns({"seq": F.lit(seq).cast("long"), "batch": F.lit(batch), "bytes": F.lit(size).cast("long")})
    pending = f"{root}/pending/{batch}"
    rows.coalesce(1).write.json(pending)  # a row a unit
    total = spark.read.schema("rows long").json(pending).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not total:  # files without rows
        delete(spark, target)
        delete(spark, pending)
        return Written(None, 0, 0)
    fs, source = place(spark, pending)
    _, goal = place(spark, f"{root}/manifests/{seq:012d}-{batch}")
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"the manifest of batch {batch} could not be put in place")
    return Written(batch, total, size)


def read(spark: SparkSession, root: str, zone: Zone) -> DataFrame:
    """The zone's rows; without a batch an empty table.  Batches that are replaced as a whole are not read."""
    log = _manifests(spark, root, zone)
    if log is None:
        return zone.parted(spark.createDataFrame([], zone.schema))
    live = log.groupBy(*zone.units).agg(F.max_by("batch", "seq").alias("batch"))
    counts = log.groupBy("batch").agg(F.count("*").alias("all")).join(live.groupBy("batch").agg(F.count("*").alias("live")), "batch").collect()  # a row a batch
    table = lambda batches: spark.read.option("basePath", f"{root}/batches").parquet(*[f"{root}/batches/batch={b}" for b in sorted(batches)])
    whole, part = [r["batch"] for r in counts if r["live"] == r["all"]], [r["batch"] for r in counts if r["live"] < r["all"]]
    parts = [table(whole)] if whole else []
    if part:
        parts.append(table(part).join(live.where(F.col("batch").isin(part)), ["batch", *zone.units], "left_semi"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.drop("batch")


def compact(spark: SparkSession, root: str, zone: Zone) -> Written:
    """All rows as one batch, after which those before it go.  For when nobody reads."""
    log = _manifests(spark, root, zone)
    old = [] if log is None else [(r["seq"], r["batch"]) for r in log.select("seq", "batch").distinct().collect()]
    done = write_batch(read(spark, root, zone), root, zone)
    for seq, batch in old:  # the manifest first: a batch without one is not there
        delete(spark, f"{root}/manifests/{seq:012d}-{batch}")
        delete(spark, f"{root}/batches/batch={batch}")
    return done
