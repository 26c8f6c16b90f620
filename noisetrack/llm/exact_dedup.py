"""Exact duplicates: a 128-bit content hash groups, bytes decide, one stable id stays.

Only a thin table (id, hash) is grouped; counts and ids are pre-aggregated before the shuffle, so a hot group costs one
row a task.  The hashes of groups of two or more then pick the rows that have copies, and only their texts are stored and
shuffled: each is compared byte by byte with the text of its group's representative, in a join whose skewed keys Spark can
split.  A row that differs (a hash collision) goes into a group of its own text.  The group table is broadcast up to
``BROADCAST_GROUPS`` rows (some 20 MB) and joined by a shuffle beyond.

Edge cases: null texts equal the empty text; a row without doc_id stays only if its whole group has none; repeated rows
(same id and text) are members of the group each, ``kept`` marks them alike and ``drop_duplicates`` returns one of them;
an empty table gives an empty result; extra columns are kept by ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import ascii_lower, stored

BROADCAST_GROUPS = 200_000


def find_duplicates(docs: DataFrame, keep: str = "max", row: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and with ``row`` all columns as the
    struct ``_row``.

    ``keep``: "min" or "max", which id of a group stays.
    """
    best = {"min": F.min, "max": F.max}[keep]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    norm = ascii_lower(F.col("_row.text") if row else F.col("text"))
    rows = docs.select(F.col("doc_id"), whole.alias("_row")) if row else docs.select("doc_id", "text")
    rows = rows.withColumn("hash", F.md5(norm.cast("binary")))
    extra = ["_row"] if row else []

    groups = stored(rows.groupBy("hash").agg(best("doc_id").alias("rep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "dedup-groups")
    side = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
    sha = F.sha2(norm.cast("binary"), 256).alias("text_sha256")
    # An outer join, as Spark would move the digests behind an anti join, which beyond the bound would then shuffle the texts.
    marked = rows.select("doc_id", "hash", sha, *extra).join(side.select("hash", "group_size"), "hash", "left")
    single = marked.where("group_size IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", *extra)

    copies = stored(rows.join(side, "hash"), "dedup-copies")
    representatives = copies.where(F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("hash", norm.alias("rep_norm")).dropDuplicates(["hash"])
    representatives = stored(representatives, "dedup-representatives")
    # Null where the bytes equal the representative's; else the differing text itself.
    # Stored, so that the join's stage ends with it: an aggregation in the same stage would keep Spark from splitting hot keys.
    copies = stored(copies.join(representatives, "hash", "left").select("doc_id", "hash", F.when(norm != F.col("rep_norm"), norm).alias("other"), sha, *extra), "dedup-compared")
    classes = copies.groupBy("hash", "other").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = classes.withColumnsRenamed({"hash": "class_hash", "other": "class_other"})
    copies = copies.join(classes, (F.col("hash") == F.col("class_hash")) & F.col("other").eqNullSafe(F.col("class_other"))).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", *extra
    )
    return single.unionByName(copies)


def drop_duplicates(docs: DataFrame, keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = find_duplicates(docs, keep, row=True).where("kept")
    copies = found.where("group_size > 1").dropDuplicates(["doc_id", "text_sha256"])  # repeated rows of the id that stays
    return found.where("group_size = 1").unionByName(copies).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
