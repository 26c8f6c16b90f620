"""Conversation structure repair by edit distance to ``(s?(ua)+)?``, with Four-Russians block tables.

A row keeps its role or is given one, is deleted, or rows are put in; an automaton of four states reads the roles that
result.  The cost of the cheapest rest of a conversation, one number for each state, goes from its last row to its first.
Less its least entry that vector is one of a few (``Tables.vectors``), so the tables hold for every vector and every block
of ``BLOCK`` symbols the vector before the block and what it adds; rows are processed a block at a time by look-up.  For the
edits themselves blocks are expanded the other way, from the first row on: at each row the letter that comes first in ASCII
of those that still reach the least cost, so that among the cheapest edits the least string results.

Rows are dealt to ranges by conversation, turn, role, the text's MD5 and a salt and sorted there, so that a conversation of any
size is split.  A conversation that lies inside a range and has at most ``SEGMENT`` rows is repaired as it streams by.  All others are cut into
segments of at most ``SEGMENT`` rows.  Their first uses of a text are found by an aggregation of digests.  The blocks of a segment together map each
vector to another one (tasks compose that map side by side); the segments' maps are chained from the last to the first, then the
states from the first to the last, each a stream of one short row a segment; then each segment is traced by itself.  Only the
hash of a repaired conversation has to see its rows in order in one task, which holds one segment at a time.

Edge cases: a null conv_id is a conversation of its own, null roles and texts are one space, and null turns come first; rows
of equal turn stand in order of role and the text's MD5, and repeated rows each count; a role with another initial can't be kept; empty
and blank texts are deleted; long texts are used whole, while a segment also ends after ``SEGMENT_CHARS`` characters; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noisetrack.llm.common import column_list, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK, SEGMENT, SEGMENT_CHARS = 4, 2_000, 4_000_000
#: States of the automaton: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE_OF = {"u": "user", "a": "assistant"}
#: The role that may be put in or given at a state, and the state after it.
GIVEN = ("u", "u", "a", "u")
AFTER = tuple(MOVES[q, c] for q, c in enumerate(GIVEN))
#: Symbols: a row that must go; rows with initial s, u, a or another, whole and truncated; and none, which fills up blocks.
GONE, NONE = 0, 9
SYMBOLS = 10
LEGAL = frozenset({"su", "ua", "au"})
SPACE = " \t\n\v\f\r"
ENDS = ".!?"


def symbol(role: str, truncated: bool) -> int:
    return 1 + 2 * ("s", "u", "a", role[:1]).index(role[:1]) + truncated


def initial_of(sym: int) -> str:
    return "sua-"[(sym - 1) // 2]


def inserted(costs: list[int]) -> list[int]:
    """Costs where rows may be put in first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[AFTER[q]]) for q, c in enumerate(costs)]
    return costs


def before(sym: int, after: tuple[int, ...]) -> list[int]:
    """Costs of the cheapest rest in front of a row, from those behind it."""
    if sym == NONE:
        return list(after)
    out = []
    for q in range(4):
        best = DELETE + after[q]
        if sym != GONE:
            extra = TRUNCATED * ((sym - 1) % 2)
            if (to := MOVES.get((q, initial_of(sym)))) is not None:
                best = min(best, KEEP + extra + after[to])
            best = min(best, REROLE + extra + after[AFTER[q]])
        out.append(best)
    return inserted(out)


class Tables:
    """vectors: the normalised cost vectors; step and added: by symbol and vector, the vector before a row and what is added
    to the least entry; block_step and block_added: the same for each block of symbols; moves: by symbol, vector behind the
    row and state in front of it, the letters of the best edits up to the row's own and the state behind it."""

    def __init__(self) -> None:
        end = inserted([0, 10**6, 10**6, 0])
        self.vectors = [tuple(end)]
        number, rows, at = {self.vectors[0]: 0}, [], 0
        while at < len(self.vectors):
            for sym in range(SYMBOLS):
                costs = before(sym, self.vectors[at])
                least = min(costs)
                key = tuple(c - least for c in costs)
                if key not in number:
                    number[key] = len(self.vectors)
                    self.vectors.append(key)
                rows.append((number[key], least))
            at += 1
        table = np.array(rows, np.int64).reshape(len(self.vectors), SYMBOLS, 2).transpose(1, 0, 2)
        self.step, self.added = np.ascontiguousarray(table[:, :, 0]), np.ascontiguousarray(table[:, :, 1])
        step, added = self.step, self.added
        for _ in range(BLOCK - 1):  # one symbol more in front
            inner, sums = step, added
            step = np.concatenate([self.step[s][inner] for s in range(SYMBOLS)])
            added = np.concatenate([self.added[s][inner] + sums for s in range(SYMBOLS)])
        self.block_step, self.block_added = step, added
        self.moves = [[[self._move(sym, v, q) for q in range(4)] for v in range(len(self.vectors))] for sym in range(SYMBOLS - 1)]
        self.rest = [self._rest(q) for q in range(4)]
        self.first_step, self.first_added = step[:, 0].tolist(), added[:, 0].tolist()

    def _move(self, sym: int, v: int, q: int) -> tuple[str, int]:
        after, costs, letters = self.vectors[v], before(sym, self.vectors[v]), ""
        while True:
            if costs[q] == DELETE + after[q]:
                return letters + "D", q
            if costs[q] == INSERT + costs[AFTER[q]]:
                letters, q = letters + "I", AFTER[q]
                continue
            extra = TRUNCATED * ((sym - 1) % 2)
            to = MOVES.get((q, initial_of(sym)))
            return (letters + "K", to) if to is not None and costs[q] == KEEP + extra + after[to] else (letters + "R", AFTER[q])

    def _rest(self, q: int) -> str:
        letters = ""
        while q not in (START, ASSISTANT):
            letters, q = letters + "I", AFTER[q]
        return letters

    def blocks(self, symbols: bytes) -> np.ndarray:
        """Numbers of the blocks; the first one is filled up in front."""
        x = np.full(-(-len(symbols) // BLOCK) * BLOCK, NONE, np.int64)
        x[len(x) - len(symbols) :] = np.frombuffer(symbols, np.uint8)
        return x.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))

    def mapping(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the rows the one in front of them and what is added."""
        v, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for b in self.blocks(symbols)[::-1]:
            total += self.block_added[b][v]
            v = self.block_step[b][v]
        return v, total

    def forward(self, symbols: bytes, behind: int = 0) -> tuple[int, list[int]]:
        """What the rows add, and the vector behind each block, from the vector behind all of them."""
        v, total, ends = behind, 0, []
        for b in self.blocks(symbols)[::-1].tolist():
            ends.append(v)
            total += int(self.block_added[b, v])
            v = int(self.block_step[b, v])
        return total + self.vectors[v][START], ends[::-1]

    def trace(self, symbols: bytes, ends: list[int], q: int) -> tuple[list[str], int]:
        """The letters of each row's edits and the state behind the last one; blocks are expanded one after the other."""
        letters: list[str] = []
        lead = -len(symbols) % BLOCK
        for k, v in enumerate(ends):
            rows = symbols[max(0, k * BLOCK - lead) : (k + 1) * BLOCK - lead]
            behind = [v]
            for s in rows[:0:-1]:
                behind.append(int(self.step[s, behind[-1]]))
            for s, w in zip(rows, reversed(behind), strict=True):
                text, q = self.moves[s][w][q]
                letters.append(text)
        return letters, q


@cache
def tables() -> Tables:
    return Tables()


def fault(text: str, seen: bool) -> int:
    """1 blank, 2 duplicate, 3 truncated, 0 none: the first that holds."""
    bare = text.rstrip(SPACE)
    return 1 if not bare else 2 if seen else 3 if bare[-1] not in ENDS else 0


def apply(letters: list[str], q: int, roles: list[str], texts: list[str], last: bool) -> list[str]:
    """Lines that the edits leave, from the state in front of the first row."""
    lines, auto = [], tables()
    for edits, role, text in zip(letters, roles, texts, strict=True):
        for e in edits:
            if e == "D":
                continue
            if e == "I":
                lines.append(f"{ROLE_OF[GIVEN[q]]}:")
            else:
                lines.append(f"{role}:{text}" if e == "K" else f"{ROLE_OF[GIVEN[q]]}:{text}")
            q = MOVES[q, role[:1]] if e == "K" else AFTER[q]
    if last:
        for _ in auto.rest[q]:
            lines.append(f"{ROLE_OF[GIVEN[q]]}:")
            q = AFTER[q]
    return lines


def sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


class Count:
    """Figures of consecutive rows that can be added up."""

    NAMES = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_role", "last_role", "first_turn", "last_turn")

    def __init__(self, turns: list, roles: list[str]) -> None:
        some = [t for t in turns if t is not None]
        self.rows, self.turns = len(roles), len(set(some))
        self.low, self.high = (min(some), max(some)) if some else (None, None)
        self.first_role, self.last_role = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
        self.first_turn, self.last_turn = (some[0], some[-1]) if some else (None, None)
        self.illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FIELDS = [x.split()[0] for x in RESULT.split(", ")]
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def repaired(turns: list, roles: list[str], texts: list[str]) -> tuple:
    """The result of a whole conversation, its rows in order."""
    auto, seen, faults = tables(), set(), []
    for key in zip(roles, texts, strict=True):
        faults.append(fault(key[1], key in seen))
        seen.add(key)
    symbols = bytes(GONE if f in (1, 2) else symbol(r, f == 3) for f, r in zip(faults, roles, strict=True))
    cost, ends = auto.forward(symbols)
    letters, q = auto.trace(symbols, ends, START)
    count = Count(turns, roles)
    return (count.gaps(), faults.count(1), faults.count(2), faults.count(3), count.illegal, cost, "".join(letters) + auto.rest[q], sha(apply(letters, START, roles, texts, True)))


# ---------------------------------------------------------------- Spark


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0 to 2: how often the row is there) after the damage by checksum."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(some("text"), ENDS, "")).otherwise(some("text"))
    role = F.when(kind == 4, "user").otherwise(some("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 0, "").otherwise(role).alias("role"), F.when(kind == 0, "").otherwise(text).alias("text"), copies.cast("int").alias("copies"))


def intact(rows: DataFrame) -> DataFrame:
    """The rows as they are, in the form of ``damaged``."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), F.lit(1).alias("copies"))


def repair(rows: DataFrame, segment: int = SEGMENT, ranges: int | None = None) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows: ``damaged`` or ``intact``.  ranges: into how many the rows are dealt."""
    id_type = rows.schema["conv_id"].dataType
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["conv_id", "turn", "role", "_md5", "_salt"]
    salted = rows.withColumns({"_md5": F.md5(F.col("text").cast("binary")), "_salt": F.monotonically_increasing_id()})
    ordered = salted.repartitionByRange(n, *key).sortWithinPartitions(*key).drop("_md5", "_salt")
    arrow_id = pa.int64() if id_type.simpleString() == "bigint" else None
    stats = "rows long, illegal long, turns long, low long, high long, first_role string, last_role string, first_turn long, last_turn long"
    stat_names = [x.split()[0] for x in stats.split(", ")]

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, size = TaskContext.get().partitionId(), 0, 0
        opened, conv, alone, pieces = False, None, False, 0  # alone: it began in this task, behind another conversation
        turns, roles, texts, chars = [], [], [], 0
        out: list[dict] = []

        def piece() -> None:
            nonlocal seg, pieces, turns, roles, texts, chars
            count = Count(turns, roles)
            out.append({"conv_id": conv, "part": part, "seg": seg, "roles": roles, "texts": texts} | {k: getattr(count, k) for k in stat_names})
            seg, pieces = seg + 1, pieces + 1
            turns, roles, texts, chars = [], [], [], 0

        def close(follows: bool) -> None:
            nonlocal turns, roles, texts, chars
            if alone and follows and not pieces:
                out.append({"conv_id": conv, "x": dict(zip(FIELDS, repaired(turns, roles, texts) if roles else NOTHING, strict=True))})
                turns, roles, texts, chars = [], [], [], 0
            elif roles or not pieces:
                piece()

        for batch in it:
            for c, turn, role, text, copies in zip(*[column_list(batch, x) for x in ("conv_id", "turn", "role", "text", "copies")], strict=True):
                if not opened or c != conv:
                    if opened:
                        close(True)
                    alone, opened, conv, pieces = opened, True, c, 0
                for _ in range(copies):
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
                    chars += len(text)
                    size += len(text)
                    if len(roles) >= segment or chars >= SEGMENT_CHARS:
                        piece()
                if len(out) >= 2_000 or size > SEGMENT_CHARS:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
                    out.clear()
                    size = 0
        if opened:
            close(False)
        yield pa.RecordBatch.from_pylist(out, schema=kinds)

    id_arrow = arrow_id or pa.string()
    inner = pa.struct([(x.split()[0], pa.int64() if x.endswith(" long") else pa.string()) for x in RESULT.split(", ")])
    kinds = pa.schema([("conv_id", id_arrow), ("part", pa.int32()), ("seg", pa.int64()), ("x", inner), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *((x.split()[0], pa.int64() if x.endswith(" long") else pa.string()) for x in stats.split(", "))])
    id_name = "long" if arrow_id else "string"
    ordered = ordered.withColumns({"conv_id": F.col("conv_id").cast(id_name), "turn": F.col("turn").cast("long")})
    done = stored(ordered.mapInArrow(cut, f"conv_id {id_name}, part int, seg long, x struct<{RESULT.replace(' ', ':').replace(',:', ',')}>, roles array<string>, texts array<string>, {stats}"), "conversation-segments")
    whole = done.where("part IS NULL").select("conv_id", "x.*")
    pieces = assembled(done.where("part IS NOT NULL").drop("x"))
    return whole.unionByName(pieces).withColumn("conv_id", F.col("conv_id").cast(id_type))


def assembled(segments: DataFrame) -> DataFrame:
    """Results of conversations that are split into segments (part, seg: their order)."""
    place = F.struct("part", "seg", "at")
    uses = segments.select("conv_id", "part", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "r"))
    digest = F.md5(F.concat(F.length("r.roles").cast("string"), F.lit(":"), F.col("r.roles"), F.col("r.texts")).cast("binary"))
    first = uses.groupBy("conv_id", digest.alias("digest")).agg(F.min(place).alias("p")).groupBy("p.part", "p.seg").agg(F.sort_array(F.collect_list("p.at")).alias("firsts"))  # a segment's rows at most
    marked = segments.join(first, ["part", "seg"], "left")

    def faults(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = tables()
        for batch in it:
            out = []
            for roles, texts, firsts in zip(*[column_list(batch, c) for c in ("roles", "texts", "firsts")], strict=True):
                fresh = set(firsts or ())
                found = [fault(t, k not in fresh) for k, t in enumerate(texts)]
                symbols = bytes(GONE if f in (1, 2) else symbol(r, f == 3) for f, r in zip(found, roles, strict=True))
                step, added = auto.mapping(symbols)
                out.append({"blank": found.count(1), "duplicate": found.count(2), "truncated": found.count(3), "symbols": symbols, "step": step.tolist(), "added": added.tolist()})
            yield pa.RecordBatch.from_arrays([*batch.columns, *pa.RecordBatch.from_pylist(out, schema=pa.schema([("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("symbols", pa.binary()), ("step", pa.list_(pa.int64())), ("added", pa.list_(pa.int64()))])).columns], [*batch.schema.names, "blank", "duplicate", "truncated", "symbols", "step", "added"])

    more = "blank long, duplicate long, truncated long, symbols binary, step array<long>, added array<long>"
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marked.schema.fields)
    marked = stored(marked.mapInArrow(faults, f"{fields}, {more}"), "conversation-symbols")

    def chained(df: DataFrame, descending: bool):
        order = [F.desc("part"), F.desc("seg")] if descending else ["part", "seg"]
        return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)

    def backward(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vector behind each segment; total: the cost from its first row on."""
        auto, conv, opened, v, total = tables(), None, False, 0, 0
        for batch in it:
            out = []
            for c, part, seg, step, added in zip(*[column_list(batch, x) for x in ("conv_id", "part", "seg", "step", "added")], strict=True):
                last = not opened or c != conv
                if last:
                    conv, opened, v, total = c, True, 0, 0
                behind = v
                total += added[v]
                v = step[v]
                out.append({"part": part, "seg": seg, "behind": behind, "last": last, "total": total + auto.vectors[v][START]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int32()), ("seg", pa.int64()), ("behind", pa.int64()), ("last", pa.bool_()), ("total", pa.int64())]))

    behind = chained(marked.select("conv_id", "part", "seg", "step", "added"), True).mapInArrow(backward, "part int, seg long, behind long, last boolean, total long")

    def exits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each state in front of a segment the one behind it."""
        auto = tables()
        for batch in it:
            out = []
            for symbols, v in zip(column_list(batch, "symbols"), column_list(batch, "behind"), strict=True):
                ends = auto.forward(symbols, v)[1]
                out.append([auto.trace(symbols, ends, q)[1] for q in range(4)])
            keep = [c for c in batch.schema.names if c != "symbols"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(out, pa.list_(pa.int64()))], [*keep, "exits"])

    figures = ["blank", "duplicate", "truncated", "rows", "illegal", "turns", "low", "high", "first_role", "last_role", "first_turn", "last_turn"]
    thin = marked.select("conv_id", "part", "seg", *figures, "symbols").join(behind, ["part", "seg"])
    kinds = {f.name: f.dataType.simpleString() for f in thin.schema.fields}
    names = [c for c in thin.columns if c != "symbols"]
    thin = stored(thin.mapInArrow(exits, ", ".join(f"{c} {kinds[c]}" for c in names) + ", exits array<long>"), "conversation-exits")

    def entries(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, opened, q = None, False, START
        for batch in it:
            out = []
            for c, part, seg, ways in zip(*[column_list(batch, x) for x in ("conv_id", "part", "seg", "exits")], strict=True):
                if not opened or c != conv:
                    conv, opened, q = c, True, START
                out.append({"part": part, "seg": seg, "entry": q})
                q = ways[q]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int32()), ("seg", pa.int64()), ("entry", pa.int64())]))

    entry = chained(thin.select("conv_id", "part", "seg", "exits"), False).mapInArrow(entries, "part int, seg long, entry long")

    def traced(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = tables()
        for batch in it:
            out = []
            for conv, part, seg, roles, texts, symbols, v, last, q in zip(*[column_list(batch, x) for x in ("conv_id", "part", "seg", "roles", "texts", "symbols", "behind", "last", "entry")], strict=True):
                letters, after = auto.trace(symbols, auto.forward(symbols, v)[1], q)
                lines = apply(letters, q, roles, texts, last)
                out.append({"conv_id": conv, "part": part, "seg": seg, "audit": "".join(letters) + (auto.rest[after] if last else ""), "lines": "\n".join(lines) if lines else None})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([batch.schema.field("conv_id"), ("part", pa.int32()), ("seg", pa.int64()), ("audit", pa.string()), ("lines", pa.string())]))

    id_name = kinds["conv_id"]
    fat = marked.select("conv_id", "part", "seg", "roles", "texts", "symbols").join(thin.select("part", "seg", "behind", "last"), ["part", "seg"]).join(entry, ["part", "seg"])
    fat = fat.mapInArrow(traced, f"conv_id {id_name}, part int, seg long, audit string, lines string")

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One segment at a time: a conversation's hash can only be taken in order."""
        conv, opened, digest, audit, begun = None, False, None, [], False
        out: list[dict] = []
        for batch in it:
            for c, letters, lines in zip(*[column_list(batch, x) for x in ("conv_id", "audit", "lines")], strict=True):
                if not opened or c != conv:
                    if opened:
                        out.append({"conv_id": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                    conv, opened, digest, audit, begun = c, True, hashlib.sha256(), [], False
                audit.append(letters)
                if lines is not None:
                    digest.update((("\n" if begun else "") + lines).encode("utf-8", "surrogatepass"))
                    begun = True
            yield pa.RecordBatch.from_pylist(out, schema=kind)
            out = []
        if opened:
            out.append({"conv_id": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema=kind)

    kind = pa.schema([("conv_id", pa.int64() if id_name == "bigint" else pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    hashes = chained(fat, False).mapInArrow(hashed, f"conv_id {id_name}, audit string, repaired_sha256 string")

    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")]
    sums = thin.groupBy("conv_id").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), F.min_by("total", F.struct("part", "seg")).alias("cost"))
    # Each of the three has one row a conversation; grouping them takes null conv_ids, which a join would not.
    out = sums.unionByName(seams_of(thin), True).unionByName(hashes, True)
    out = out.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in out.columns if c != "conv_id"])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - F.coalesce("shared", F.lit(0))), F.lit(0))
    illegal = F.col("illegal") + F.coalesce("between", F.lit(0))
    return out.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", illegal.alias("illegal"), "cost", "audit", "repaired_sha256")


def seams_of(thin: DataFrame) -> DataFrame:
    """By conversation: between (illegal pairs of roles from one segment to the next) and shared (turns that go on in the next
    segment); one short row a segment."""
    w = Window.partitionBy("conv_id").orderBy("part", "seg")
    pair = F.concat("_role", "first_role")
    rows = thin.where("rows > 0").select("conv_id", "first_role", "first_turn", F.lag("last_role").over(w).alias("_role"), F.lag("last_turn").over(w).alias("_turn"))
    return rows.groupBy("conv_id").agg(F.count_if(F.col("_role").isNotNull() & ~pair.isin(*sorted(LEGAL))).alias("between"), F.count_if(F.col("_turn") == F.col("first_turn")).alias("shared"))
