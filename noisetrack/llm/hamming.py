"""Fingerprints within a Hamming radius: block tables for candidates, bit-sliced comparison, connected components.

``block_keys`` cuts a fingerprint of ``bits`` bits into radius + equal blocks; fingerprints that differ in at most
``radius`` bits agree in ``equal`` of the blocks at least, so the tables of all choices of ``equal`` blocks hold every
pair.  ``links`` deals the rows by key.  Buckets of more than ``TILE`` fingerprints are dealt to pairs of tiles, so no
task holds a whole hot bucket, and every pair still meets.

A task sorts its rows by key and stores the fingerprints as bit planes.  All rows are compared with their d-th successor
in the bucket at once, 64 lanes a word: the planes' differences are summed by carry-save counters, and a block of planes
is the last one looked at if all lanes exceed the radius by then.  Of the pairs found only a spanning forest of each
bucket is returned, at most one row a member, never all pairs.  Where pairs are to be verified afterwards, ``closest``
returns pairs as they were found: all of a small bucket, and of a large one a forest of the closest, at most two a member;
what verification leaves open in the large ones is for the caller (``simhash_dedup.open_links``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noisetrack.llm.common import kept, scratch, stored

TILE, CLOSE_TILE, SMALL = 2048, 512, 32
BITS_PER_TASK = 400_000 * 64
BROADCAST_KEYS = 100_000
PLANES_PER_BLOCK = 16
WORDS_AT_ONCE = 4096


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(name)).to_pylist()), np.uint8).reshape(-1, width)


def binary_array(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def block_keys(fps: DataFrame, bits: int, radius: int, equal: int = 1) -> DataFrame:
    """(key, fp) of each distinct ``fp`` in each block table."""
    edges = [round(i * bits / (radius + equal)) for i in range(radius + equal + 1)]
    tables = [np.concatenate([np.arange(edges[b], edges[b + 1]) for b in chosen]) for chosen in combinations(range(radius + equal), equal)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                rows = fingerprints(part, "fp", bits // 8)
                plain = np.unpackbits(rows, axis=1)
                column = part.column(part.schema.get_field_index("fp"))
                for number, chosen in enumerate(tables):
                    packed = np.packbits(plain[:, chosen], axis=1)
                    padded = np.zeros((len(rows), -(-packed.shape[1] // 8) * 8), np.uint8)
                    padded[:, : packed.shape[1]] = packed
                    key = np.full(len(rows), number + 1, np.uint64)
                    for word in padded.view(np.uint64).T:
                        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + word)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), column], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp binary")


class Lanes:
    """Rows sorted by bucket, compared with their d-th successors."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray, radius: int) -> None:
        self.radius, self.digits = radius, max(1, radius.bit_length())
        self.at = np.arange(len(keys))  # places in the caller's arrays
        self._set(keys, rows)

    def _set(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.keys, self.rows = keys, rows
        n = len(keys)
        if n:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, n))
            self.size = np.repeat(sizes, sizes)
            planes = np.packbits(np.unpackbits(rows, axis=1).T, axis=1, bitorder="little")
            self.planes = np.zeros((planes.shape[0], -(-n // 64) * 8), np.uint8)
            self.planes[:, : planes.shape[1]] = planes
            self.planes = self.planes.view(np.uint64)
        self.n = n

    def _shifted(self, d: int) -> np.ndarray:
        words, bits = divmod(d, 64)
        out = np.zeros_like(self.planes)
        w = self.planes.shape[1]
        if words < w:
            out[:, : w - words] = self.planes[:, words:] >> np.uint64(bits)
            if bits and words + 1 < w:
                out[:, : w - words - 1] |= self.planes[:, words + 1 :] << np.uint64(64 - bits)
        return out

    def _within(self, shifts: list[int]) -> np.ndarray:
        """Words of lanes (one row a shift) that lie within the radius."""
        w = self.planes.shape[1]
        valid = np.zeros((len(shifts), w * 8), np.uint8)
        for k, d in enumerate(shifts):
            if d < self.n:
                same = np.packbits(self.keys[d:] == self.keys[:-d], bitorder="little")
                valid[k, : len(same)] = same
        alive = valid.view(np.uint64).reshape(-1)
        diff = np.concatenate([self._shifted(d) ^ self.planes for d in shifts], axis=1)
        digit = [np.zeros_like(alive) for _ in range(self.digits)]
        over = ~alive
        for b, plane in enumerate(diff):
            carry = plane
            for j in range(self.digits):  # carry-save: add one bit to every lane's counter
                digit[j], carry = digit[j] ^ carry, digit[j] & carry
            over |= carry
            if (b + 1) % PLANES_PER_BLOCK == 0 and not np.any(~(over | self._more(digit))):
                return np.zeros((len(shifts), w), np.uint64)
        return (~(over | self._more(digit))).reshape(len(shifts), w)

    def _more(self, digit: list[np.ndarray]) -> np.ndarray:
        """Lanes whose counter exceeds the radius."""
        more, equal = np.zeros_like(digit[0]), np.full_like(digit[0], 2**64 - 1)
        for j in reversed(range(self.digits)):
            if self.radius >> j & 1:
                equal &= digit[j]
            else:
                more |= equal & digit[j]
                equal &= ~digit[j]
        return more

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        d = 1
        while self.n:
            stay = self.size > d
            if stay.sum() <= self.n // 2 or not stay.any():
                self.at = self.at[stay]
                self._set(self.keys[stay], self.rows[stay])
                if not self.n:
                    return
            last = int(self.size.max()) - 1
            shifts = list(range(d, min(last, d + max(1, WORDS_AT_ONCE // self.planes.shape[1]) - 1) + 1))
            found = self._within(shifts)
            if found.any():
                bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
                k, i = np.nonzero(bits)
                yield self.at[i], self.at[i + np.array(shifts)[k]]
            d = shifts[-1] + 1


def forest(keys: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """For each row (sorted by key) the first row of its bucket it is linked to, by one or more steps."""
    label = np.arange(len(keys))
    for i, j in Lanes(keys, rows, radius).pairs():
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while not np.array_equal(up := label[label], label):
                label = up
    return label


def closest_pairs(keys: np.ndarray, rows: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of buckets of ``SMALL`` rows or fewer; of larger ones a spanning forest by increasing distance."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    few = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    if len(few):
        for i, j in Lanes(keys[few], rows[few], radius).pairs():
            yield few[i], few[j]
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        own = rows[start : start + size]
        found = [(i.astype(np.int32), j.astype(np.int32), np.bitwise_count(own[i] ^ own[j]).sum(1, dtype=np.int16)) for i, j in Lanes(np.zeros(size, np.int64), own, radius).pairs()]
        if not found:
            continue
        i, j, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        label = np.arange(size)
        for d in np.unique(distance):
            a, b = i[distance == d], j[distance == d]
            while len(a):
                la, lb = label[a], label[b]
                open_ = la != lb
                a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
                if not len(a):
                    break
                # The first pair of each part joins it to another.
                _, first = np.unique(np.concatenate([la, lb]), return_index=True)
                chosen = np.unique(first % len(a))
                yield start + a[chosen], start + b[chosen]
                np.minimum.at(label, np.maximum(la, lb)[chosen], np.minimum(la, lb)[chosen])
                while not np.array_equal(up := label[label], label):
                    label = up


def links(candidates: DataFrame, bits: int, radius: int, closest: bool = False) -> DataFrame:
    """(a, b) pairs of linked fingerprints, a spanning forest of each bucket of ``candidates`` (key, fp); with ``closest``
    of linked nodes of ``candidates`` (key, node, fp), pairs that were themselves found within the radius."""
    tile, own = (CLOSE_TILE, ["node", "fp"]) if closest else (TILE, ["fp"])
    spark = candidates.sparkSession
    counts = candidates.groupBy("key").agg(F.count("*").alias("n"))
    size = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > tile).alias("big")).first()
    n = size["n"] or 0
    if size["big"]:
        big = stored(counts.where(F.col("n") > tile), "hamming-big")
        # As many keys as fit a proven bound are broadcast; more are joined by a shuffle.
        split = candidates.join(F.broadcast(big) if size["big"] <= BROADCAST_KEYS else big, "key", "left").withColumn("tiles", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)))
        split = split.withColumn("t", F.pmod(F.xxhash64(own[0]), F.col("tiles"))).withColumn("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        one = F.col("tiles") == 1
        candidates = split.select(F.when(one, F.col("key")).otherwise(F.xxhash64("key", F.least("t", "u"), F.greatest("t", "u"))).alias("key"), *own)
        n += big.agg(F.sum(F.col("n") * F.ceil(F.col("n") / tile))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * bits // BITS_PER_TASK))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(zero_copy_only=False), fingerprints(b, "fp", bits // 8), fingerprints(b, "node", 16) if closest else None) for b in it if b.num_rows]
        if not got:
            return
        keys, rows = np.concatenate([k for k, _, _ in got]), np.concatenate([r for _, r, _ in got])
        names = np.concatenate([x for _, _, x in got]) if closest else rows
        _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        some = counts[which] > 1
        keys, rows, names = keys[some], rows[some], names[some]
        order = np.lexsort([*rows.T[::-1], keys])
        keys, rows, names = keys[order], rows[order], names[order]
        if closest:
            pairs = closest_pairs(keys, rows, radius)
        else:
            label = forest(keys, rows, radius)
            joined = np.flatnonzero(label != np.arange(len(label)))
            pairs = iter([(joined, label[joined])])
        for i, j in pairs:
            for at in range(0, len(i), 20_000):
                yield pa.RecordBatch.from_arrays([binary_array(names[i[at : at + 20_000]]), binary_array(names[j[at : at + 20_000]])], ["a", "b"])

    return candidates.repartition(parts, "key").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root the smallest node it is connected to; by large-star and
    small-star steps until nothing changes (some log n rounds)."""
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(now)
    spark = edges.sparkSession
    for _ in range(rounds if before[0] else 0):
        now = components_round(spark, now)
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def components_round(spark: SparkSession, now: DataFrame) -> DataFrame:
    """A large-star and a small-star step."""
    with scratch(spark):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are stored, so that both sides of the joins are plain shuffles, whose hot keys Spark can split.
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "components-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stored(large, "components-large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components-low")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        return kept(small, "components")
