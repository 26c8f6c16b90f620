"""Spelling variants: words one edit apart, found in a frequency-vector trie.

A word is described by how often letters of each of ``GROUPS`` occur in it.  One edit changes that vector by one letter too
many, one too few, or one of each, so a depth-first search through a trie of the vectors may spend one surplus and one
deficit on its way; the words in the leaves that it reaches are verified.  A pair is looked for from one side: from the word
whose first difference is a surplus of the other, and of words with equal vectors from the lesser one.  The upper levels of the trie are the shuffle
key: each word is built into the node of its own first counts and asked in every node that the budget reaches.  So many
levels are taken that no node holds more than ``NODE_WORDS`` words (words that agree in all counts stay together), and a
task holds one node's trie while the words to ask stream by.  What is found is added up for both words in the task; pairs of
words are never written.

Edge cases: null and empty texts have no words; a null doc_id is the empty text in the damage rule; repeated rows count
each; of near words with equal counts the first in code-point order is the form; a word without a form is its own root; an
empty table gives an empty result; extra columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import UPPER, column_list, stored

#: Letters by their use in the four languages; all others are the last group.
GROUPS = ("e", "n", "a", "i", "t", "r", "s", "o", "hl", "dcu", "mpgb")
LEVELS = len(GROUPS) + 1
LEAST_CHARS, LEAST_USES, TIMES = 6, 5, 5
DAMAGE = 199
NODE_WORDS, LEAF_WORDS = 4_000, 6
WORDS_AT_ONCE = 200_000

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_CHARS},}}")  # shorter runs can't give a word
_LOWER = str.maketrans(UPPER, UPPER.lower())
_GROUP_OF = {c: k for k, group in enumerate(GROUPS) for c in group}


def count_runs(doc_id, text: str, held: dict[str, int], known: dict[str, tuple[str, bytes]]) -> None:
    """Adds the words of a text as they count: lower-cased, and of every 199th run (by its checksum) one letter deleted.
    known: lower-cased runs that were seen."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text)).items():
        try:
            word, raw = known[run]
        except KeyError:
            word = run.translate(_LOWER)
            raw = word.encode()
            known[run] = word, raw
        h = zlib.crc32(raw, start)
        if h % DAMAGE == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST_CHARS:
                continue
        held[word] = held.get(word, 0) + n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of at least six letters with at least five uses."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        known: dict[str, tuple[str, bytes]] = {}
        for batch in it:
            for doc_id, text in zip(column_list(batch, "doc_id"), column_list(batch, "text"), strict=True):
                if text:
                    count_runs(doc_id, text, held, known)
                if len(held) >= WORDS_AT_ONCE:
                    yield table(held)
                    held = {}
                if len(known) >= WORDS_AT_ONCE:
                    known.clear()
        yield table(held)

    def table(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_USES)


def letters_in(word: Column, depth: int) -> Column:
    """The first ``depth`` counts of a word's vector as text."""
    size = lambda c: F.length(c)
    return F.concat_ws(".", *[(size(word) - size(F.translate(word, g, ""))).cast("string") for g in GROUPS[:depth]])


def vector(word: str) -> list[int]:
    out = [0] * LEVELS
    for c in word:
        out[_GROUP_OF.get(c, LEVELS - 1)] += 1
    return out


def reachable(counts: list[int]) -> Iterator[tuple[list[int], int]]:
    """Prefixes that a surplus and then a deficit can turn these counts into, with what is spent: 0 nothing, 1 the surplus, 2
    both."""
    yield counts, 0
    for i in range(len(counts)):
        more = [*counts]
        more[i] += 1
        yield more, 1
        for j in range(i + 1, len(counts)):
            if counts[j]:
                both = [*more]
                both[j] -= 1
                yield both, 2


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point.  One edit leaves either the first or
    the last half of the shorter word as it is."""
    if len(a) > len(b):
        a, b = b, a
    longer, half = len(b) - len(a), len(a) >> 1
    if longer > 1 or a[:half] != b[:half] and a[half:] != b[half + longer :] or a == b:
        return False
    same = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        same += 1
    return a[same + 1 - longer :] == b[same + 1 :]


def build(words: list[tuple[str, int, list[int]]], level: int):
    """A dictionary count -> subtree for each level, or a list of words where few are left or all levels are used."""
    if level == LEVELS or len(words) <= LEAF_WORDS:
        return words
    parts: dict[int, list] = {}
    for w in words:
        parts.setdefault(w[2][level], []).append(w)
    return {count: build(part, level + 1) for count, part in parts.items()}


def search(trie, level: int, word: str, counts: list[int], spent: int) -> Iterator[tuple[str, int]]:
    """Near words in the trie with their uses, as the budget allows."""
    todo = [(trie, level, spent)]
    while todo:
        node, at, spent = todo.pop()
        if isinstance(node, list):
            for other, n, vector_ in node:
                if one_edit(word, other) and (at == LEVELS or asks_below(counts, vector_, at, spent)) and (spent or vector_ != counts or word < other):
                    yield other, n
            continue
        own = counts[at]
        if own in node:
            todo.append((node[own], at + 1, spent))
        if spent == 0 and own + 1 in node:
            todo.append((node[own + 1], at + 1, 1))
        elif spent == 1 and own - 1 in node:
            todo.append((node[own - 1], at + 1, 2))


def asks_below(counts: list[int], other: list[int], at: int, spent: int) -> bool:
    """Whether the rest of the levels keeps the order of a surplus before a deficit; for leaves that end early."""
    for a, b in zip(counts[at:], other[at:], strict=True):
        if a != b:
            return b > a if spent == 0 else spent == 1
    return True


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """word, n_near and best (of the near words, the one with most uses: best.n, best.word) of words that have near ones.

    words: word, n; each once."""
    depth = 1
    while depth < len(GROUPS) and (words.groupBy(letters_in(F.col("word"), depth).alias("k")).count().agg(F.max("count")).first()[0] or 0) > node_words:
        depth += 1

    def route(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: list[list] = [[] for _ in names]
            for word, n in zip(column_list(batch, "word"), column_list(batch, "n"), strict=True):
                counts = vector(word)[:depth]
                # First as a word to find, then as one to ask.
                for prefix, spent in ((counts, -1), *reachable(counts)):
                    for column, x in zip(out, (".".join(map(str, prefix)), spent, word, n), strict=True):
                        column.append(x)
                if len(out[0]) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    names, kinds = ["node", "spent", "word", "n"], [pa.string(), pa.int32(), pa.string(), pa.int64()]

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, trie = None, [], None
        found: dict[str, list] = {}  # of the node's words: number, uses and letters of the best

        def table() -> pa.RecordBatch:
            columns = zip(*((w, *x) for w, x in found.items()), strict=True) if found else [[]] * 4
            out = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])
            found.clear()
            return out

        def add(word: str, other: str, n: int) -> None:
            x = found.get(word)
            if x is None:
                found[word] = [1, n, other]
                return
            x[0] += 1
            if n > x[1] or n == x[1] and other < x[2]:
                x[1:] = n, other

        for batch in it:
            for node, spent, word, n in zip(*[column_list(batch, c) for c in names], strict=True):
                if node != at:
                    at, held, trie = node, [], None
                if spent < 0:
                    held.append((word, n, vector(word)))
                    continue
                if trie is None:
                    if not held:
                        continue
                    trie = build(held, depth)
                for other, m in search(trie, depth, word, vector(word), spent):
                    add(word, other, m)
                    add(other, word, n)
                if len(found) > WORDS_AT_ONCE:
                    yield table()
        yield table()

    routed = words.select("word", "n").mapInArrow(route, "node string, spent int, word string, n long")
    asked = routed.repartition("node").sortWithinPartitions("node", "spent").mapInArrow(ask, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("x")
    return asked.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", F.struct((-F.col("x.less")).alias("n"), "x.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the ends of the paths word -> form, each step doubling the length of the paths.  A form has five times
    the uses, so paths are short and have no circles."""
    paths = stored(forms.select("word", F.col("form").alias("root")), "variant-paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(paths.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-paths")
        if not longer.where("moved").limit(1).count():
            return longer.select("word", "root")
        paths = longer.select("word", "root")


def group_variants(docs: DataFrame) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    words = stored(vocabulary(docs), "variant-words")
    near = near_words(words)
    is_form = F.col("best.n") >= TIMES * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.n")).alias("form_n")
    )
    out = stored(out, "variant-forms")
    ends = roots(out.where("form IS NOT NULL"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
