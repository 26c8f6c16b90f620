"""Language-model scores by deleted interpolation.

P(w | h) = a(h) * c(h w) / c(h) + b(h) * c(w) / N + g(h) / (V + 1), where the weights (a, b, g) depend on the bucket of
c(h), in powers of two, and are learned by expectation-maximisation on deleted counts: documents of one training fold are
scored with their own counts taken out.

How it runs.  Documents are tokenised once into chunks of a bounded number of tokens, kept as number arrays in the shared
folder.  Each chunk sends its distinct words and word pairs (64-bit hashes, sorted, as differences) to buckets of the
hash; a bucket adds up the training counts and answers each chunk in the order asked.  A chunk sends ``FAN_OUT`` messages at
most: a corpus that needs more buckets is asked in two steps, chunks to groups of buckets, and units of ``UNIT_CHUNKS``
chunks, their keys merged, from a group to its buckets.  The second step's messages are chunks times buckets by
``UNIT_CHUNKS``, still a square, which by these constants stays below the number of chunks' own messages up to some 10 TB
(1e9 there) and is 9e10 at 100 TB; far beyond, a third step would be needed.  So counts of the whole corpus are exact up to hash collisions, no table of counts is broadcast, a frequent word
costs one entry a chunk, and what a task holds is bounded by the chunk, unit and bucket sizes.  Only totals and the histogram for the weights (bounded by its bins)
reach the driver.

Edge cases: null and empty texts consist of the end token; rows without doc_id are held out; repeated rows count as often
as they occur; an empty table gives an empty result; without training rows every probability is that of the unknown word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import Numbered, column_bytes, column_list, crc_mod, stored

CHUNK_TOKENS = 1_500_000
BUCKET_KEYS = 2_000_000
FAN_OUT, UNIT_CHUNKS = 4096, 1024
FOLDS, DEV_FOLD = 10, 1
CONTEXT_BUCKETS = 20
STEP = 4  # histogram bins an octave of probability
END = b"\n"


def pack(a: np.ndarray) -> bytes:
    """Byte planes, then zstd."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw, width = np.frombuffer(zstandard.decompress(data), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind) if len(raw) else np.zeros(0, kind)


def pair_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit keys of word pairs; odd, while those of words are even."""
    x = history * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(29))) | np.uint64(1)


class Grams:
    """Words, pairs and sorted keys of a chunk."""

    def __init__(self, tokens: np.ndarray, vocabulary: np.ndarray) -> None:
        self.tokens = tokens
        self.history = np.concatenate([np.zeros(1, tokens.dtype), tokens[:-1]])  # 0 is the end token
        pairs, self.pair_of = np.unique(self.history.astype(np.uint64) << np.uint64(32) | tokens, return_inverse=True)
        words = vocabulary[(pairs >> np.uint64(32)).astype(np.int64)], vocabulary[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        keys = np.concatenate([vocabulary, pair_keys(*words)])
        self.n_words, self.order = len(vocabulary), np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def counts(self, token_mask: np.ndarray) -> np.ndarray:
        """Counts of the marked tokens and their pairs, in the order of the keys."""
        a = np.bincount(self.tokens[token_mask], minlength=self.n_words)
        b = np.bincount(self.pair_of[token_mask], minlength=len(self.keys) - self.n_words)
        return np.concatenate([a, b])[self.order].astype(np.uint32)

    def spread(self, by_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the order of the keys back to words and pairs."""
        out = np.empty(len(by_key), by_key.dtype)
        out[self.order] = by_key
        return out[: self.n_words], out[self.n_words :]


CHUNK_SCHEMA = "chunk string, dev boolean, doc_ids array<{id}>, train binary, lengths binary, tokens binary, vocabulary binary, n_tokens long, n_train long"


def chunks(docs: DataFrame) -> DataFrame:
    """One row for some hundred thousand tokens of documents, the development fold apart."""
    rows = docs.select("doc_id", "text", crc_mod(F.col("doc_id"), FOLDS).cast("int").alias("fold"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        open_ = {dev: ([], [], [], [], Numbered({END: 0}), [0]) for dev in (False, True)}

        def flush(dev: bool) -> pa.RecordBatch:
            nonlocal serial
            ids, train, lengths, tokens, vocabulary, total = open_[dev]
            open_[dev] = ([], [], [], [], Numbered({END: 0}), [0])
            serial += 1
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary)) & np.uint64(2**64 - 2)
            lens, flags = np.array(lengths, np.uint32), np.array(train, np.uint8)
            one = [f"{part}-{serial}" + "-dev" * dev, dev, ids, pack(flags), pack(lens), pack(np.concatenate(tokens)), pack(hashes), total[0], int(lens[flags > 0].sum())]
            kinds = [pa.string(), pa.bool_(), pa.list_(id_type), *[pa.binary()] * 4, pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds, strict=True)], names)

        for batch in it:
            id_type = batch.column(0).type
            for doc_id, text, fold in zip(column_list(batch, "doc_id"), column_bytes(batch, "text"), column_list(batch, "fold"), strict=True):
                dev = fold == DEV_FOLD
                ids, train, lengths, tokens, vocabulary, total = open_[dev]
                words = text.lower().split()
                words.append(END)
                ids.append(doc_id)
                train.append(fold != 0)
                lengths.append(len(words))
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
                total[0] += len(words)
                if total[0] >= CHUNK_TOKENS:
                    yield flush(dev)
        for dev in (False, True):
            if open_[dev][0]:
                yield flush(dev)

    schema = CHUNK_SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())
    names = [x.split()[0] for x in schema.split(", ")]
    return rows.mapInArrow(run, schema)


MESSAGE = "bucket long, chunk string, keys binary, counts binary"
ANSWER = "chunk string, bucket long, counts binary, wide boolean, new_words long"


def messages(chunk: str, keys: np.ndarray, counts: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their counts, cut by buckets (the top bits)."""
    bucket = keys >> np.uint64(64 - n_buckets.bit_length() + 1) if n_buckets > 1 else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, np.int64)
    spans = list(zip(bucket[starts].astype(np.int64).tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True))
    for k in range(0, len(spans), 64):
        part = spans[k : k + 64]
        columns = [
            pa.array([b for b, _, _ in part], pa.int64()),
            pa.array([chunk] * len(part)),
            pa.array([pack(np.diff(keys[i:j], prepend=np.uint64(0))) for _, i, j in part], pa.binary()),
            pa.array([pack(counts[i:j].astype(np.uint32)) for _, i, j in part], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "keys", "counts"])


def added_up(asked: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each message; of all messages the distinct keys, the place of each message's keys there, and the sums."""
    keys = [np.cumsum(unpack(x, "u8"), dtype=np.uint64) for x in asked.column("keys").to_pylist()]
    counts = np.concatenate([unpack(x, "u4") for x in asked.column("counts").to_pylist()])
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, distinct, which, np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.uint64)


def answers(names: list[str], buckets: list[int], keys: list[np.ndarray], counts: np.ndarray, new_words: int) -> pa.Table:
    """For each message the counts of its keys; ``counts`` has them one message after the other."""
    wide = counts.max(initial=0) >= 2**32
    ends = np.cumsum([len(k) for k in keys])[:-1]
    packed = pa.array([pack(x.astype("u8" if wide else "u4")) for x in np.split(counts, ends)], pa.binary())
    return pa.table({"chunk": names, "bucket": pa.array(buckets, pa.int64()), "counts": packed, "wide": [bool(wide)] * len(names), "new_words": pa.array([new_words] + [0] * (len(names) - 1), pa.int64())})


def global_counts(table: DataFrame, n_buckets: int) -> DataFrame:
    """chunk, bucket, counts: for each chunk's keys of a bucket their counts in all training documents; new_words: words
    with such a count, told once a bucket."""
    n_groups = min(n_buckets, FAN_OUT)

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for chunk, train, lengths, tokens, vocabulary in zip(*(column_list(batch, c) for c in ("chunk", "train", "lengths", "tokens", "vocabulary")), strict=True):
                grams = Grams(unpack(tokens, "u4"), unpack(vocabulary, "u8"))
                counts = grams.counts(np.repeat(unpack(train, "u1") > 0, unpack(lengths, "u4")))
                yield from messages(chunk, grams.keys, counts, n_groups)

    def answer(asked: pa.Table) -> pa.Table:
        keys, distinct, which, total = added_up(asked)
        new = int(((distinct & np.uint64(1)) == 0)[total > 0].sum())
        return answers(asked.column("chunk").to_pylist(), asked.column("bucket").to_pylist(), keys, total[which], new)

    asked = table.select("chunk", "train", "lengths", "tokens", "vocabulary").mapInArrow(ask, MESSAGE)
    if n_buckets == n_groups:
        return asked.groupBy("bucket").applyInArrow(answer, ANSWER)

    def merge(part: pa.Table) -> pa.Table:
        _, distinct, _, total = added_up(part)
        return pa.Table.from_batches(list(messages(part.column("unit")[0].as_py(), distinct, total, n_buckets)))

    def hand_back(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, _, which, _ = added_up(left)
        parts = sorted(right.select(["bucket", "counts", "wide", "new_words"]).to_pylist(), key=lambda r: r["bucket"])
        counts = np.concatenate([unpack(r["counts"], "u8" if r["wide"] else "u4").astype(np.uint64) for r in parts])
        return answers(left.column("chunk").to_pylist(), left.column("bucket").to_pylist(), keys, counts[which], sum(r["new_words"] for r in parts))

    n_units = max(1, -(-table.count() // UNIT_CHUNKS))
    unit = F.concat_ws("/", F.col("bucket").cast("string"), F.pmod(F.xxhash64("chunk"), F.lit(n_units)).cast("string"))
    asked = stored(asked.withColumn("unit", unit), "lm-asked")
    answered = stored(asked.groupBy("unit").applyInArrow(merge, MESSAGE).groupBy("bucket").applyInArrow(answer, ANSWER), "lm-answered")
    return asked.groupBy("unit").cogroup(answered.groupBy("chunk")).applyInArrow(hand_back, ANSWER)


def with_counts(left: pa.Table, right: pa.Table) -> tuple[Grams, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's grams, its documents' lengths and training flags, and the corpus counts of its words and pairs."""
    row = left.to_pylist()[0]
    grams = Grams(unpack(row["tokens"], "u4"), unpack(row["vocabulary"], "u8"))
    parts = sorted(right.select(["bucket", "counts", "wide"]).to_pylist(), key=lambda r: r["bucket"])
    counts = np.concatenate([unpack(r["counts"], "u8" if r["wide"] else "u4").astype(np.int64) for r in parts])
    words, pairs = grams.spread(counts)
    return grams, unpack(row["lengths"], "u4").astype(np.int64), unpack(row["train"], "u1") > 0, words, pairs


def context_bucket(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, CONTEXT_BUCKETS - 1), 0)


def learn_weights(joined, n_train: int, n_words: int, rounds: int = 60) -> np.ndarray:
    """(CONTEXT_BUCKETS, 3) weights by EM over a histogram of deleted probabilities."""

    def histogram(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, lengths, _, words, pairs = with_counts(left, right)
        ends = np.cumsum(lengths)
        bins: list[np.ndarray] = []
        for start, end in zip(ends - lengths, ends, strict=True):
            w, p, h = grams.tokens[start:end], grams.pair_of[start:end], grams.history[start:end]
            own_w, own_w_n = np.unique(w, return_counts=True)
            _, p_at, own_p_n = np.unique(p, return_inverse=True, return_counts=True)
            at = np.searchsorted(own_w, w)
            c_w = words[w] - own_w_n[at]
            h_at = np.minimum(np.searchsorted(own_w, h), len(own_w) - 1)
            c_h = words[h] - np.where(own_w[h_at] == h, own_w_n[h_at], 0)
            c_hw = pairs[p] - own_p_n[p_at]
            unit = n_words + 1
            r1 = np.maximum(c_w, 0) / max(1, n_train - len(w)) * unit
            r2 = np.maximum(c_hw, 0) / np.maximum(c_h, 1) * unit
            q = [np.where(r > 0, np.round(STEP * np.log2(np.maximum(r, 1e-300))) + 500, 0).astype(np.int64) for r in (r2, r1)]
            bins.append((context_bucket(c_h) * 1000 + q[0]) * 1000 + q[1])
        found, n = np.unique(np.concatenate(bins), return_counts=True)
        return pa.table({"bin": found, "n": n})

    rows = joined.applyInArrow(histogram, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect()
    weights = np.tile(np.array([0.0, 0.6, 0.4]), (CONTEXT_BUCKETS, 1))
    weights[1:] = [0.5, 0.3, 0.2]
    if not rows:
        return weights if n_train else np.tile(np.array([0.0, 0.0, 1.0]), (CONTEXT_BUCKETS, 1))
    code, n = np.array([r["bin"] for r in rows]), np.array([float(r["n"]) for r in rows])
    value = lambda q: np.where(q > 0, np.exp2((q - 500) / STEP), 0.0)
    context, p = code // 1_000_000, np.stack([value(code // 1000 % 1000), value(code % 1000), np.ones(len(code))], 1)
    for _ in range(rounds):
        share = p * weights[context]
        share *= (n / share.sum(1))[:, None]
        for b in range(CONTEXT_BUCKETS):
            seen = share[context == b].sum(0)
            if seen.sum() > 0:
                weights[b] = (seen + [0.0 if b == 0 else 1e-3, 1e-3, 1e-3]) / (seen.sum() + (2e-3 if b == 0 else 3e-3))
    return weights


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    table = stored(chunks(docs), "lm-chunks")
    size = table.agg(F.sum("n_tokens").alias("n"), F.sum("n_train").alias("t")).first()
    n_all, n_train = size["n"] or 0, size["t"] or 0
    least = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_buckets = 1 << math.ceil(math.log2(max(least, n_all / BUCKET_KEYS)))
    counts = stored(global_counts(table, n_buckets), "lm-counts")
    n_words = counts.agg(F.sum("new_words")).first()[0] or 0
    dev = table.where("dev").groupBy("chunk").cogroup(counts.where(F.col("chunk").endswith("-dev")).groupBy("chunk"))
    weights = learn_weights(dev, n_train, n_words)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, lengths, train, words, pairs = with_counts(left, right)
        c_w, c_h, c_hw = words[grams.tokens], words[grams.history], pairs[grams.pair_of]
        w = weights[context_bucket(c_h)]
        p = w[:, 0] * (c_hw / np.maximum(c_h, 1)) + w[:, 1] * (c_w / max(1, n_train)) + w[:, 2] / (n_words + 1)
        base = np.log10((c_w + 0.1) / (n_train + 0.1 * (n_words + 1)))
        starts = np.cumsum(lengths) - lengths
        return pa.table(
            {
                "doc_id": left.column("doc_ids").combine_chunks().flatten(),
                "held_out": ~train,
                "n_tokens": lengths,
                "n_known": np.add.reduceat((c_w > 0).astype(np.int64), starts),
                "train_tokens": np.full(len(lengths), n_train),
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(p), starts),
            }
        )

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return table.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(score, schema)
