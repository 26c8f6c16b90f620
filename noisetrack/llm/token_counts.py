"""Token counts by offset-mapped attribution.

A document (its fields joined by newlines) is encoded once, so that counts add up to what a model reads.  The byte spans
of the tokens are joined as intervals with the spans of the sections: fields, and the lines of the text with their line
ends.  A token that crosses a boundary is allocated by rule: "start" (the section of its first byte), "most" (the section
with most of its bytes, the earlier on a tie) or "share" (to each section the part of its bytes).

Edge cases: a null field is an empty section without tokens, and an empty text one empty line; repeated rows are counted
alike; whole texts are encoded; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from noisetrack.llm.common import column_list
from noisetrack.llm.tokens import ByteTokens

RULES = ("start", "most", "share")


def allocate(lengths: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and tokens that cross each section's end, from byte lengths of tokens and byte ends of
    sections (ascending; an empty section ends where the one before does)."""
    stop = np.cumsum(lengths)
    start = stop - lengths
    first = np.searchsorted(ends, start, "right")
    last = np.searchsorted(ends, stop - 1, "right")
    n = len(ends)
    crossing = np.bincount(first[first != last], minlength=n).astype(np.int64)
    if rule == "start":
        return np.bincount(first, minlength=n).astype(float), crossing
    inside = first == last
    counts = np.bincount(first[inside], minlength=n).astype(float)
    for t in np.flatnonzero(~inside):
        sections = np.arange(first[t], last[t] + 1)
        begins = np.concatenate([[0], ends[:-1]])[sections]
        part = np.maximum(0, np.minimum(ends[sections], stop[t]) - np.maximum(begins, start[t]))
        if rule == "most":
            counts[sections[np.argmax(part)]] += 1
        else:
            counts[sections] += part / lengths[t]
    return counts, crossing


def count_tokens(docs: DataFrame, fields: tuple[str, ...] = ("source", "lang"), rule: str = "start") -> DataFrame:
    """One row per section: doc_id, section (its number), kind (a field's name or "line"), start_byte, n_bytes, n_tokens,
    n_crossing (tokens that go on into the next section) and doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens()
        for batch in it:
            index: list[int] = []
            out: list[list] = [[] for _ in range(7)]
            values = [column_list(batch, f) for f in fields]
            for row, text in enumerate(column_list(batch, "text")):
                heads = [("" if v[row] is None else str(v[row])) + "\n" for v in values]
                parts = heads + split_lines(text or "")
                lengths = np.array([len(p.encode("utf-8", "replace")) for p in parts], np.int64)
                ends = np.cumsum(lengths)
                ids = tokens.encode("".join(parts))
                counts, crossing = allocate(tokens.lengths[ids], ends, rule) if len(ids) else (np.zeros(len(parts)), np.zeros(len(parts), np.int64))
                index += [row] * len(parts)
                for column, x in zip(out, (range(len(parts)), [*fields, *["line"] * (len(parts) - len(fields))], ends - lengths, lengths, counts, crossing, [len(ids)] * len(parts)), strict=True):
                    column.extend(x)
                if len(index) > 50_000:
                    yield table(batch, index, out)
                    index, out = [], [[] for _ in range(7)]
            yield table(batch, index, out)

    def table(batch: pa.RecordBatch, index: list[int], out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(index, pa.int64())), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, section long, kind string, start_byte long, n_bytes long, n_tokens double, n_crossing long, doc_tokens long"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("doc_id", "text", *fields).mapInArrow(run, schema)


def split_lines(text: str) -> list[str]:
    """Lines with their line feeds; an empty text is one empty line."""
    lines = text.split("\n")
    parts = [line + "\n" for line in lines[:-1]]
    return parts + [lines[-1]] if lines[-1] or not parts else parts
