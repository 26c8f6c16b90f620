"""SimHash near-duplicates with bit-sliced comparison (see ``hamming``).

``shingle_fingerprints`` makes 64-bit fingerprints whose bits are the majority of the shingles' hashes; ``near_groups``
links those that differ in at most ``radius`` bits, by block tables, and gives each document the smallest id it is
connected to.

Texts as alike as 0.8 (five-word shingles) differ in some 10 of 64 bits, where block tables have no selective keys.  For
that case ``drop_near_duplicates`` uses wide fingerprints (512 bits, each distinct shingle votes once) and min-wise hashes
of the shingles as keys: documents that share one of the bands (20 of 4) meet in a bucket, where the same bit-sliced
comparison picks pairs by distance, and the pairs are verified on their sets of shingles.  No size of a bucket decides what
is verified: in buckets of more than 32 a forest of the closest comes first, and where verified pairs don't join all of such
a bucket, ``open_links`` takes the sets along and verifies in the task every pair within the radius whose parts aren't
joined yet.  So a pair of 0.8 or more is lost only if it shares no band (probability below 0.00003) or differs in more than
136 bits where some 78 are expected (seven standard deviations; five for sets of four and five shingles).

Equal fingerprints, for ``drop_near_duplicates`` equal sets of shingles (by a 128-bit hash), are one node, so a group of
copies costs a row however large it is.

Edge cases: null and empty texts have no words, fingerprint zero, and are linked like any other; texts of fewer words than
a shingle are one shingle; a row without doc_id takes part, and a group of only such rows has a null component; repeated
rows are in one group; an empty table gives an empty result; extra columns are kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import column_bytes, column_list, small, stored
from noisetrack.llm.hamming import BROADCAST_KEYS, CLOSE_TILE, SMALL, Lanes, binary_array, block_keys, components, links, mixed

SEED, ROWS_AT_ONCE, SHINGLES_PER_TILE = 42, 4096, 1_000_000


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def majority(words: np.ndarray) -> np.ndarray:
    """Bits set in over half the rows of an array of 64-bit words, most significant first, as bytes."""
    if not len(words):
        return np.zeros(words.shape[1] * 8, np.uint8)
    counts = np.zeros(words.shape[1] * 64, np.int64)
    for at in range(0, len(words), ROWS_AT_ONCE):
        part = np.ascontiguousarray(words[at : at + ROWS_AT_ONCE]).astype(">u8").view(np.uint8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.uint16)
    return np.packbits(counts * 2 > len(words))


def shingle_fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id and the 64-bit fingerprint ``fp`` (8 bytes) of each row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [majority(shingle_hashes(x, shingle_words)[:, None]).tobytes() for x in column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp binary")


def with_components(marked: DataFrame, found: DataFrame, node: str = "fp") -> DataFrame:
    """Adds component_id to rows (doc_id, ``node``): the smallest doc_id of all rows whose nodes have a root in ``found``."""
    classes = marked.groupBy(node).agg(F.min("doc_id").alias("first"))
    # Stored, so that the joins below are plain shuffles, whose hot roots and nodes Spark can split.
    rooted = stored(classes.join(found.withColumnRenamed("node", node), node, "left").withColumn("root", F.coalesce("root", node)), "simhash-rooted")
    lowest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    named = stored(rooted.join(small(lowest), "root").select(node, "component_id"), "simhash-named")
    return marked.join(small(named), node)


def near_groups(docs: DataFrame, shingle_words: int = 3, radius: int = 3, equal: int = 2) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    marked = stored(shingle_fingerprints(docs, shingle_words), "simhash")
    keys = block_keys(stored(marked.select("fp").distinct(), "simhash-distinct"), 64, radius, equal)
    return with_components(marked, components(links(keys, 64, radius)))


class MinHash:
    """Keys of bands of min-wise hashes."""

    def __init__(self, bands: int, rows: int) -> None:
        state = np.random.RandomState(7)
        self.a = state.randint(1, 2**62, bands * rows, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = state.randint(1, 2**62, bands * rows, dtype=np.int64).astype(np.uint64)
        self.shape = (bands, rows)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), 2**64 - 1, np.uint64)
        for at in range(0, len(hashes), ROWS_AT_ONCE):
            part = hashes[at : at + ROWS_AT_ONCE, None]
            low = np.minimum(low, (((part ^ self.b) * self.a) ^ (part >> np.uint64(29))).min(0))
        key = np.arange(1, self.shape[0] + 1, dtype=np.uint64)
        for column in low.reshape(self.shape).T:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
        return key


def set_node(distinct: np.ndarray) -> bytes:
    """A 128-bit hash of a set of shingles (sorted hashes)."""
    return xxhash.xxh3_128_digest(distinct.tobytes(), SEED)


def wide_fingerprints(docs: DataFrame, shingle_words: int, bits: int, bands: int, rows: int) -> DataFrame:
    """doc_id, node (see ``set_node``), fp (``bits`` bits), keys, one for each band, and size of the set of each row."""
    words = bits // 64
    steps = mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(bands, rows)
        for batch in it:
            nodes, fps, keys, sizes = [], [], [], []
            for text in column_bytes(batch, "text"):
                distinct = np.unique(shingle_hashes(text, shingle_words))
                nodes.append(set_node(distinct))
                sizes.append(len(distinct))
                fps.append(majority(mixed(distinct[:, None] + steps)))  # repeats don't vote, as they don't count in the similarity
                keys.append(minhash.keys(distinct).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), binary_array(fps), pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["doc_id", "node", "fp", "keys", "size"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, fp binary, keys array<long>, size long")


def shingle_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """node and its set of shingles, once a node."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [np.unique(shingle_hashes(text, shingle_words)) for text in column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(map(set_node, sets), pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], ["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node binary, shingles array<long>").dropDuplicates(["node"])


def sets_of(docs: DataFrame, marked: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """The sets of shingles of some nodes, made for their texts only."""
    ids = stored(marked.join(small(nodes), "node", "left_semi").select(F.col("doc_id").alias("_id")).distinct(), "simhash-ids")
    some = docs.select("doc_id", "text").join(small(ids), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return stored(shingle_sets(some, shingle_words), "simhash-sets")


def verified(docs: DataFrame, marked: DataFrame, pairs: DataFrame, shingle_words: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets of shingles have a Jaccard similarity of ``least`` or more."""
    pairs = stored(pairs.distinct(), "simhash-pairs")
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "simhash-nodes")
    sets = sets_of(docs, marked, nodes, shingle_words)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= least * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def joining_pairs(labels: np.ndarray, rows: np.ndarray, sets: list[np.ndarray], radius: int, least: float) -> list[tuple[int, int]]:
    """Pairs within the radius of a similarity of ``least`` or more, the closest first, each of which joins two parts: all
    other such pairs lie within a part then."""
    found = [(i.astype(np.int32), j.astype(np.int32), np.bitwise_count(rows[i] ^ rows[j]).sum(1, dtype=np.int16)) for i, j in Lanes(np.zeros(len(rows), np.int64), rows, radius).pairs()]
    if not found:
        return []
    i, j, distance = (np.concatenate(x) for x in zip(*found, strict=True))
    sizes, label, out = np.array([len(x) for x in sets]), labels.copy(), []
    may = (label[i] != label[j]) & (np.minimum(sizes[i], sizes[j]) >= least * np.maximum(sizes[i], sizes[j]))
    i, j, distance = i[may], j[may], distance[may]
    order = np.argsort(distance, kind="stable")
    i, j = i[order], j[order]
    for at in range(0, len(i), ROWS_AT_ONCE):
        a, b = i[at : at + ROWS_AT_ONCE], j[at : at + ROWS_AT_ONCE]
        open_ = label[a] != label[b]
        for x, y in zip(a[open_].tolist(), b[open_].tolist(), strict=True):
            if label[x] != label[y]:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if common >= least * (len(sets[x]) + len(sets[y]) - common):
                    out.append((x, y))
                    label[label == label[y]] = label[x]
    return out


def open_links(docs: DataFrame, marked: DataFrame, keys: DataFrame, found: DataFrame, shingle_words: int, bits: int, radius: int, least: float) -> DataFrame | None:
    """Verified pairs (a, b) between parts (roots in ``found``) of buckets of more than ``SMALL`` rows; None if there is no
    such bucket of several parts.

    A bucket's rows outside its largest part are compared with each other and with the largest part, in tiles of bounded
    rows and shingles; the largest part's rows are not compared with each other."""
    large = stored(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SMALL).select("key"), "simhash-large")
    n = large.count()
    if not n:
        return None
    rows = keys.join(F.broadcast(large) if n <= BROADCAST_KEYS else large, "key").join(found, "node", "left")
    rows = stored(rows.select("key", "node", "fp", "size", F.coalesce("root", "node").alias("label")), "simhash-parts")
    parts = rows.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    tiles = lambda n, s: F.greatest(F.lit(1), F.ceil(n / CLOSE_TILE), F.ceil(s / SHINGLES_PER_TILE)).cast("long")
    most = parts.groupBy("key").agg(F.max(F.struct("n", "label", "s")).alias("m"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("parts"))
    most = most.where("parts > 1").select("key", F.col("m.label").alias("main"), tiles(F.col("m.n"), F.col("m.s")).alias("tm"), tiles(F.col("n") - F.col("m.n"), F.col("s") - F.col("m.s")).alias("tr"))
    most = stored(most, "simhash-open")
    n = most.count()
    if not n:
        return None
    rows = rows.join(F.broadcast(most) if n <= BROADCAST_KEYS else most, "key").withColumn("main", F.col("label") == F.col("main"))
    rows = stored(rows.withColumn("t", F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("tm")).otherwise(F.col("tr")))), "simhash-open-rows")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    unit = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    t = F.col("t")
    rest = F.concat(F.transform(upto(F.col("tr")), lambda u: unit(0, F.least(t, u), F.greatest(t, u))), F.transform(upto(F.col("tm")), lambda m: unit(1, t, m)))
    units = F.when(F.col("main"), F.transform(upto(F.col("tr")), lambda u: unit(1, u, t))).otherwise(rest)
    sets = sets_of(docs, marked, rows.select("node").distinct(), shingle_words)
    dealt = rows.select("node", "fp", "label", "key", F.explode(units).alias("unit")).join(sets, "node").select("key", "unit.*", "node", "fp", "label", "shingles")
    dealt = dealt.repartition("key", "kind", "x", "y").sortWithinPartitions("key", "kind", "x", "y")

    def pairs(group: list[dict]) -> list[tuple[bytes, bytes]]:
        _, labels = np.unique([r["label"].hex() for r in group], return_inverse=True)
        fps = np.frombuffer(b"".join(r["fp"] for r in group), np.uint8).reshape(-1, bits // 8)
        return [(group[x]["node"], group[y]["node"]) for x, y in joining_pairs(labels, fps, [r["shingles"] for r in group], radius, least)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, group = None, []
        batch_of = lambda out: pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])
        for batch in it:
            names = ("key", "kind", "x", "y", "node", "fp", "label")
            shingles = batch.column(batch.schema.get_field_index("shingles"))
            for row, *values in zip(range(batch.num_rows), *(column_list(batch, c) for c in names), strict=True):
                r = dict(zip(names, values, strict=True)) | {"shingles": shingles[row].values.to_numpy(zero_copy_only=False).copy()}
                at = tuple(values[:4])
                if at != unit and group:
                    yield batch_of(pairs(group))
                    group = []
                unit = at
                group.append(r)
        if group:
            yield batch_of(pairs(group))

    return dealt.mapInArrow(run, "a binary, b binary")


def similar_groups(docs: DataFrame, shingle_words: int = 5, least: float = 0.8, bits: int = 512, radius: int = 136, bands: int = 20, rows: int = 4) -> DataFrame:
    """doc_id, node and component_id of each row, linked at a similarity of ``least`` or more (see above)."""
    marked = stored(wide_fingerprints(docs, shingle_words, bits, bands, rows), "simhash-wide")
    distinct = stored(marked.select("node", "fp", "keys", "size").dropDuplicates(["node"]), "simhash-distinct")
    keys = distinct.select(F.explode("keys").alias("key"), "node", "fp", "size")
    pairs = links(keys.drop("size"), bits, radius, closest=True).where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(verified(docs, marked, pairs, shingle_words, least), "simhash-edges")
    found = components(edges)
    more = open_links(docs, marked, keys, found, shingle_words, bits, radius, least)
    if more is not None:
        found = components(edges.unionByName(more))
    return with_components(marked.select("doc_id", "node"), found, "node")


def drop_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """Of each group of similar rows the one with the smallest doc_id, with all its columns.  Rows that share an id stay if
    one of them does, equal ones once."""
    groups = stored(similar_groups(docs, **parameters), "simhash-groups")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Ids whose rows go, and ids that more than one row shares (rare) or that are null, whose repeated rows are thinned.
    ids = groups.groupBy(F.col("doc_id").alias("id")).agg(F.count_if(stays).alias("n"), F.count("*").alias("all"))
    marks = stored(ids.where("n = 0 OR all > 1 OR id IS NULL").select("id", (F.col("n") == 0).alias("lost")), "simhash-marks")
    # The row is one column here, so no name of its own clashes.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.join(small(marks), F.col("row")["doc_id"].eqNullSafe(F.col("id")), "left")
    again = found.where(~F.col("lost")).select("row", F.col("row")["doc_id"].alias("id"), F.col("row")["text"].alias("text")).dropDuplicates(["id", "text"])
    return found.where(F.col("lost").isNull()).select("row").unionByName(again.select("row")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
