"""Packing: multiway Karmarkar-Karp differencing.

A document is its ids and the end id.  It is cut into full windows and a rest; the rest is cut into pieces of at most
``PIECE`` ids.  Blocks of pieces, dealt by a hash, are partitioned by differencing: the two partial partitions that
spread most are merged, the largest windows of one with the smallest of the other, until one is left; if its largest
window exceeds the capacity, the number of windows rises and the block is partitioned anew.

A block holds about ``BLOCK`` pieces whatever the input, so memory and time of a task are bounded and a hot document is
spread over blocks.  Sequence ids are (block, window).

Edge cases: a null or empty text is the end id alone; rows without doc_id are packed too; repeated rows are packed each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import column_list
from noisetrack.llm.tokens import ByteTokens

CAPACITY, PIECE, BLOCK, END = 2048, 256, 3000, 1


def difference(sizes: list[int], k: int) -> tuple[list[int], list[list[int]]]:
    """Sums and members of k windows by the largest differencing method.  Partial partitions hold only windows with
    members, largest first; the others are empty."""
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        (_, _, a, a_of), (_, _, b, b_of) = heapq.heappop(heap), heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - k)  # windows of both that must be put together
        keep = len(b) - shared
        sums, of = a[: len(a) - shared] + b[:keep], a_of[: len(a) - shared] + b_of[:keep]
        for j in range(shared):  # the smallest of one with the largest of the rest of the other, crosswise
            x, y = len(a) - 1 - j, keep + j
            sums.append(a[x] + b[y])
            of.append(a_of[x] + b_of[y])
        order = sorted(range(len(sums)), key=lambda i: -sums[i])
        sums, of = [sums[i] for i in order], [of[i] for i in order]
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, serial, sums, of))
        serial += 1
    _, _, sums, of = heap[0]
    return sums, of


def pack_windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Members of windows of at most ``capacity``, as few as differencing finds."""
    if not sizes:
        return []
    k = -(-sum(sizes) // capacity)
    while True:
        sums, of = difference(sizes, k)
        if sums[0] <= capacity:
            return of
        k += 1


def pieces(docs: DataFrame, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of the pieces, each document encoded once as a whole."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens()
        for batch in it:
            index, start, length, crc, total = [], [], [], [], []
            for row, text in enumerate(column_list(batch, "text")):
                ids = np.append(tokens.encode(text or ""), np.uint32(END)).astype("<u4")
                full = len(ids) // capacity * capacity
                cuts = [*range(0, full, capacity), *range(full, len(ids), piece), len(ids)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    index.append(row)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(index, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence_id and offset."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).first()
    # About a token for three characters and, on average, half a piece more a document.
    n_blocks = max(1, ((size["c"] or 0) // (3 * PIECE) + size["n"]) // BLOCK)
    cut = pieces(docs, capacity)
    # A row's own number spreads repeated rows and rows without id too.
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(n_blocks)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("length", "doc_id", "start", "ids_crc32")])
        lengths = rows.column("length").to_pylist()
        block = rows.column("block")[0].as_py()
        small = [i for i, n in enumerate(lengths) if n < capacity]
        windows = [[small[j] for j in w] for w in pack_windows([lengths[i] for i in small], capacity)]
        windows += [[i] for i, n in enumerate(lengths) if n == capacity]
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for number, members in enumerate(windows):
            at = 0
            for i in members:
                sequence[i], offset[i] = block << 32 | number, at
                at += lengths[i]
        out = rows.select(names)
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return cut.groupBy("block").applyInArrow(pack, schema)
