"""Quality rules: a decision list learned by sequential covering, emitted as an ordered Spark conditional expression.

``document_statistics`` counts what the rules look at, and ``features`` are ratios of these counts as columns.  ``learn``
covers the rejected documents of a labelled sample one rule after the other.  A rule is a conjunction of thresholds; it is
grown on three of four parts of the sample by information gain until it covers no good document, then its last conditions
are pruned for precision on the fourth part.  A rule that is not precise there ends the list.  ``verdict`` turns the list
into F.when(rule 1).when(rule 2)...: the number of the first rule that holds, or 0.  Scoring is that expression and never
looks at labels, lang, source or doc_id.

Edge cases: null and empty texts have no words and fail the base rule; rows without doc_id are scored and not learned from;
repeated rows are scored alike; a document labelled both ways counts as bad; labels other than 0 and 1 are not learned
from; without labels the list is empty and only the base rule rejects; ties between conditions go to the feature that comes first in ``features``, then to the lower
threshold; very long texts are counted whole; an empty table gives an empty result; extra columns are kept by
``keep_good`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import Numbered, column_bytes, crc_mod
from noisetrack.llm.toxicity import drawn

#: Bound of the labelled sample that rules are learned from.
MAX_TRAIN_DOCS = 12_000
MAX_CONDITIONS = 4
LEAST_COVERED, LEAST_PRECISION = 3, 0.9
LEAST_WORDS = 50

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_capitals", "n_digits", "n_marks", "n_letters")
SYMBOLS = b"#*$%&|<>"
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])  # every byte of other scripts counts as a letter
_MARKS = b".,;:!?"


def per(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))


def features() -> dict[str, Column]:
    """What rules put thresholds on, from the columns of ``document_statistics``."""
    return {
        "symbols_a_word": per("n_symbols", "n_words"),
        "chars_a_word": per("word_chars", "n_words"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "duplicate_lines": per("n_dup_lines", "n_lines"),
        "distinct_words": per("n_distinct", "n_words"),
        "capitals_a_char": per("n_capitals", "word_chars"),
        "digits_a_char": per("n_digits", "word_chars"),
        "marks_a_word": per("n_marks", "n_words"),
        "letters_a_char": per("n_letters", "word_chars"),
        "words_a_line": per("n_words", "n_lines"),
        "words": F.col("n_words").cast("double"),
    }


def statistics(text: bytes) -> tuple[int, ...]:
    """The counts of ``STATISTICS``; words lie between ASCII white space."""
    words = text.split()
    n = len(words)
    n_bytes = sum(map(len, words))
    following = len(text) - len(text.translate(None, bytes(range(128, 192))))  # bytes within code points
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    number = Numbered()
    ids = np.array([number[w] for w in words], np.int64)
    repeated = 0
    if n > 3:
        size = len(number)
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:] if size < 2_000_000 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)[1].ravel()
        _, back, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[back] > 1)
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[again + k] = True
        repeated = int(covered.sum())
    without = lambda some: len(text) - len(text.translate(None, some))
    return (n, n_bytes - following, without(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), len(number), without(_CAPITALS), without(_DIGITS), without(_MARKS), without(_LETTERS) - following)


def document_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``STATISTICS`` of each row, as longs."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [statistics(x) for x in column_bytes(batch, "_text")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(x, pa.int64()) for x in columns)], names)

    kept = docs.select(*keep, F.col("text").alias("_text"))
    names = [*keep, *STATISTICS]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), *(f"{c} long" for c in STATISTICS)])
    return kept.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(x) for c in rule))


def best_condition(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The threshold with the highest information gain on the rows inside, between two of their values."""
    p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
    if not p0 or not n0:
        return None
    before, best, gain = np.log2(p0 / (p0 + n0)), None, 1e-9
    for name, values in x.items():
        order = np.argsort(values[inside], kind="stable")
        v, y = values[inside][order], bad[inside][order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below_p = np.cumsum(y)[cut]
        below_n = cut + 1 - below_p
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            worth = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0)
            k = int(np.argmax(worth))
            if worth[k] > gain + 1e-9:
                gain = worth[k]
                best = Condition(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best


def grow(x: dict[str, np.ndarray], bad: np.ndarray, left: np.ndarray) -> Rule:
    rule: list[Condition] = []
    inside = left.copy()
    while len(rule) < MAX_CONDITIONS and (found := best_condition(x, bad, inside)):
        rule.append(found)
        inside &= found.holds(x)
    return tuple(rule)


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, left: np.ndarray) -> tuple[Rule, int, int]:
    """The beginning of the rule with the best (p - n) / (p + n) on these rows, the shortest on a tie, and its p and n."""
    best, value = (rule, 0, 0), -2.0
    for k in range(1, len(rule) + 1):
        held = covers(rule[:k], x) & left
        p, n = int((bad & held).sum()), int((~bad & held).sum())
        if p + n and (p - n) / (p + n) > value + 1e-9:
            best, value = (rule[:k], p, n), (p - n) / (p + n)
    return best


def decision_list(x: dict[str, np.ndarray], bad: np.ndarray, pruning: np.ndarray) -> list[Rule]:
    """Sequential covering: rules for bad rows in order, each for what those before leave over."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while (bad & left & ~pruning).sum() >= LEAST_COVERED:
        rule = grow(x, bad, left & ~pruning)
        if not rule:
            break
        rule, p, n = prune(rule, x, bad, left & pruning)
        held = covers(rule, x) & left
        all_p, all_n = int((bad & held).sum()), int((~bad & held).sum())
        if p < LEAST_COVERED or p < LEAST_PRECISION * (p + n) or all_p < LEAST_PRECISION * (all_p + all_n):
            break
        rules.append(rule)
        left &= ~held
    return rules


def learn(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> list[Rule]:
    """Rules from at most about ``max_docs`` labelled rows, chosen by a hash of doc_id; a fifth of the ids (crc32 modulo 5
    is 0) is never learned from and is there to test on."""
    train = labels.where((crc_mod(F.col("doc_id"), 5) != 0) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    ids = train.where(drawn(F.col("doc_id"), min(1.0, max_docs / max(1, train.count()))))
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # a few 100 KB at that bound
    counted = document_statistics(sample, ("doc_id", "_quality")).where(~base_failed())
    # Numbers only, as many rows as the sample's bound.
    rows = sorted(counted.select((crc_mod(F.col("doc_id"), 5) == 1).alias("pruning"), F.col("_quality").alias("quality"), *[c.alias(k) for k, c in features().items()]).collect())
    x = {k: np.array([r[k] for r in rows], float) for k in features()}
    return decision_list(x, np.array([r["quality"] == 0 for r in rows], bool), np.array([r["pruning"] for r in rows], bool)) if rows else []


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds for a row of ``document_statistics``, from 1; 0 if none does."""
    out = F.when(F.lit(False), 0)
    for k, rule in enumerate(rules, 1):
        out = out.when(reduce(Column.__and__, (c.column() for c in rule)), k)
    return out.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (its number, 0 for none) and kept of each row."""
    counted = document_statistics(docs)
    out = counted.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that the base rule and the list keep, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    counted = document_statistics(whole, ("_row",)).where(~base_failed() & (verdict(rules) == 0))
    return counted.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
