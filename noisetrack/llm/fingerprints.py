"""Document fingerprints: SimHash over word pairs.

Each distinct pair of neighbouring words votes, with weight 1 + ln(its count), on the bits of a 256-bit fingerprint.  Pairs
rather than words, because texts of one language share their frequent words.  ``within_radius`` finds, by permuted block
tables, all fingerprints within a Hamming radius; ``likeness`` is the share of equal bits.

The next document (in descending order of doc_id) meets its predecessor without a global sort in one task: rows are dealt
to ranges of some ``RANGE_BYTES``, a task goes through its range in order, and only the last row of each range waits for
the first one of the next range, in a second step over two rows a range.

Edge cases: null and empty texts have fingerprint zero; a text of one word votes with that word; ids may be of any type that
has an order; rows without doc_id come last, and they and repeated ids are ordered by a hash of their texts among themselves,
so that they are spread over ranges too; a single row is its own next document; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from noisetrack.llm.common import column_list, small, stored
from noisetrack.llm.hamming import block_keys, components, links, mixed

CHANCE_ROWS = 8
BITS, RADIUS, ROWS_AT_ONCE, CACHE, RANGE_BYTES = 256, 12, 4096, 300_000, 32 << 20
STEPS = mixed(np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def fingerprint(text: str, hashes: WordHashes) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(BITS // 8, np.uint8)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    terms = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h
    terms, counts = np.unique(terms, return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for at in range(0, len(terms), ROWS_AT_ONCE):
        bits = np.unpackbits(mixed(terms[at : at + ROWS_AT_ONCE, None] + STEPS).view(np.uint8), axis=1)
        votes += weights[at : at + ROWS_AT_ONCE] @ bits.astype(np.float32)
    return np.packbits(votes * 2 > weights.sum(dtype=np.float64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1 - int(np.bitwise_count(a ^ b).sum()) / (len(a) * 8)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id {id}, n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"


def followed(doc_id: object, text: str, fp: np.ndarray, following: str, following_fp: np.ndarray, hashes: WordHashes) -> tuple:
    """A row of the result."""
    changed = edited(text, following)
    changed_fp = fingerprint(changed, hashes)
    sha = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
    return doc_id, len(text), sha, fp.tobytes(), changed_fp.tobytes(), likeness(fp, changed_fp), likeness(fp, following_fp)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited and near_next of each row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("salt"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("b")).first()["b"] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    order = [F.col("doc_id").desc_nulls_last(), "hash", "salt"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def table(out: list[tuple], more: dict | None = None) -> pa.RecordBatch:
        """Rows of the result, or with ``more`` one row that waits for its next document or is one."""
        columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
        mark = more or {"range": None, "first": None, "text": None}
        extra = [pa.array([mark[c]] * len(out), k) for c, k in (("range", pa.int64()), ("first", pa.bool_()), ("text", pa.string()))]
        return pa.RecordBatch.from_arrays([*columns, *extra], [*names, "range", "first", "text"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, place = WordHashes(), None, TaskContext.get().partitionId()
        for batch in it:
            out: list[tuple] = []
            for doc_id, body in zip(column_list(batch, "doc_id"), column_list(batch, "text"), strict=True):
                fp = fingerprint(body, hashes)
                if last is None:
                    yield table([(None, None, None, fp.tobytes(), None, None, None)], {"range": place, "first": True, "text": body})
                else:
                    out.append(followed(*last, body, fp, hashes))
                last = doc_id, body, fp
            if out:
                yield table(out)
        if last is not None:
            yield table([(last[0], None, None, last[2].tobytes(), None, None, None)], {"range": place, "first": False, "text": last[1]})

    def join_ends(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in it:
            fps = [[np.frombuffer(x, np.uint8) for x in column_list(batch, c)] for c in ("fp", "next_fp")]
            out = [followed(i, a, fa, b, fb, hashes) for i, a, fa, b, fb in zip(column_list(batch, "doc_id"), column_list(batch, "text"), fps[0], column_list(batch, "next_text"), fps[1], strict=True)]
            if out:
                yield table(out).select(names)

    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stored(ranged.mapInArrow(run, SCHEMA.format(id=id_type) + ", range long, first boolean, text string"), "fingerprints-ranges")
    # Two rows a range: the last one's next document is the first of the next range that has rows, the very last one's the very first.
    ends = found.where("range IS NOT NULL")
    places = ends.where("first").select("range")
    following = places.select("range", F.coalesce(F.lead("range").over(Window.orderBy("range")), F.min("range").over(Window.partitionBy(F.lit(1)))).alias("follower"))
    firsts = ends.where("first").select(F.col("range").alias("follower"), F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    waiting = ends.where("NOT first").select("doc_id", "text", "fp", "range").join(following, "range").join(firsts, "follower")
    joined = waiting.select("doc_id", "text", "fp", "next_text", "next_fp").mapInArrow(join_ends, SCHEMA.format(id=id_type))
    return found.where("range IS NULL").select(*names).unionByName(joined)


def equal_blocks(rows: int, radius: int, bits: int = BITS) -> int:
    """How many equal blocks a key is made of: as few as give keys for so many rows that chance fills a bucket with
    ``CHANCE_ROWS`` at most.  More blocks are more tables, all of which hold all pairs within the radius."""
    equal = 1
    while rows > CHANCE_ROWS * 2.0 ** (equal * (bits // (radius + equal))) and equal < 4:
        equal += 1
    return equal


def within_radius(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, near_group): for each distinct fingerprint the smallest one it reaches by steps of at most ``radius`` bits."""
    distinct = stored(fps.select("fp").distinct(), "fingerprints-distinct")
    keys = block_keys(distinct, BITS, radius, equal_blocks(distinct.count(), radius))
    found = components(links(keys, BITS, radius)).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("near_group"))


def fingerprint_table(docs: DataFrame) -> DataFrame:
    marked = stored(fingerprint_documents(docs), "fingerprints")
    # Stored, so that where it is too large for a broadcast the join is of plain shuffles, whose hot fingerprints Spark can split.
    groups = stored(within_radius(marked), "fingerprints-groups")
    return marked.join(small(groups), "fp")
