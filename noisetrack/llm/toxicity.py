"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, context windows.

1. ``fit`` counts, over a bounded sample of labelled rows, how often each word and word beginning occurs in toxic and other
   documents, and keeps those that mark toxic ones (a likelihood-ratio test against the number of terms tried).  A
   beginning stands for all its endings.  The lexicon has as many terms as stand out; what bounds them is the sample.
2. ``TermAutomaton`` intersects the Levenshtein automaton of a word with the trie of the lexicon.  The product is built
   lazily as a deterministic automaton, so a word costs one look-up a letter and most words die after three letters.
3. Each hit is weighed by a context window: a hit inside quotation marks or after a reporting word counts for less, one
   that addresses the reader for more.  What a misspelling of a term is worth is learned on the same sample.
4. A logistic model of the evidence, its density and the number of hits, fitted on the sample with each document's own
   counts taken out, gives the score.

Edge cases: a null or empty text has no hits and gets the score of texts without hits; rows without doc_id are
scored and count as held out; repeated rows are scored alike; an empty label table gives every row the score 0.1;
labels other than 0 and 1 are not learned from, and a document labelled both ways counts as toxic; extra columns are kept by ``reject_toxic`` and ignored elsewhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noisetrack.llm.common import WORD_TABLE, column_bytes, column_list, crc_mod, stored

MAX_TRAIN_DOCS = 12_000
PREFIX_LENGTHS = range(3, 9)
ROUNDS, USES = 4, 4  # of learning terms; most uses of a term in a document that count
DOCS_AT_ONCE = 500
WINDOW_CHARS = 80
QUOTED, ADDRESSED = 0.35, 1.15
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Words that report what somebody said, and words that address the reader, in four languages.
REPORTING = frozenset(
    "said says wrote called quote quoted quotes reported a_dit dit disait écrit appelé cité sagte schrieb nannte zitat zitiert dijo escribió llamó cita citado".split()
)
ADDRESSING = frozenset("you your yours youre du dein deine euch ihr tu toi vous votre tus usted ustedes".split())
QUOTES = "\"“”„«»"


@dataclass
class Model:
    """terms: (letters, is_beginning); counts[term][edits]: capped uses in toxic and other documents; totals: words of
    either; weights: of ``inputs``."""

    terms: list[tuple[str, bool]] = field(default_factory=list)
    counts: list[list[tuple[int, int]]] = field(default_factory=list)
    totals: tuple[int, int] = (1, 1)
    weights: list[float] = field(default_factory=lambda: [-2.2, 0.0, 0.0, 0.0, 0.0])

    def evidence(self, term: int, edits: int, own: tuple[int, int] = (0, 0)) -> float:
        """Log of the ratio of rates, without ``own`` uses; for a misspelling, what the exact spelling says counts as
        three uses beside what was seen."""
        p, n = self.counts[term][edits]
        p, n = p - own[0], n - own[1]
        seen = math.log((p + 0.5) / self.totals[0] / ((n + 0.5) / self.totals[1]))
        return (3 * 0.7 * self.evidence(term, 0) + (p + n) * seen) / (3 + p + n) if edits else seen

    def inputs(self, n_words: int, hits: dict[tuple[int, int], float], label: int | None = None) -> list[float]:
        """hits: (term, edits) -> uses, weighed by context and capped.  label: that of a row of the sample itself."""
        total = 0.0
        for (term, edits), uses in hits.items():
            whole = math.ceil(uses)
            own = (0, 0) if label is None else (whole, 0) if label else (0, whole)
            total += uses * max(0.0, self.evidence(term, edits, own))
        some = float(bool(hits))
        return [1.0, math.log1p(total), math.log1p(1000 * total / (n_words + 20)), some, some * math.log1p(n_words)]


def allowed_edits(letters: str, beginning: bool) -> int:
    """A beginning matches any ending, so it needs more letters of its own before edits are safe."""
    length = len(letters) - 2 * beginning
    return 0 if length < 5 else 1 if length < 9 else 2


class TermAutomaton:
    """Levenshtein automata intersected with the trie of the terms, determinised as words come."""

    def __init__(self, terms: list[tuple[str, bool]]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]
        self.begin: list[int] = [-1]
        self.limit = [allowed_edits(*t) for t in terms]
        self.cap: list[int] = [0]
        for number, (letters, beginning) in enumerate(terms):
            node = 0
            self.cap[0] = max(self.cap[0], self.limit[number])
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(-1)
                    self.begin.append(-1)
                    self.cap.append(0)
                node = self.children[node][c]
                self.cap[node] = max(self.cap[node], self.limit[number])
            (self.begin if beginning else self.whole)[node] = number
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.at_once: list[tuple[int, int] | None] = []
        self.at_end: list[tuple[int, int] | None] = []
        self.step: dict[tuple[int, str], int] = {}
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes.items())
        while todo:  # letters missing from the word
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.cap[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            for kind, out in ((self.begin, self.at_once), (self.whole, self.at_end)):
                out.append(min(((e, kind[n]) for n, e in key if kind[n] >= 0 and e <= self.limit[kind[n]]), default=None))
        return self.ids[key]

    def _next(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.states[state]:
            if edits < self.cap[node]:  # a letter too many
                nodes[node] = min(nodes.get(node, 99), edits + 1)
            for c, child in self.children[node].items():
                cost = edits + (c != letter)
                if cost <= self.cap[child]:
                    nodes[child] = min(nodes.get(child, 99), cost)
        if len(self.step) > 500_000:
            self.step.clear()
        self.step[state, letter] = new = self._state(nodes)
        return new

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) with the fewest edits, or None."""
        state, best, step = self.start, None, self.step
        for letter in word:
            new = step.get((state, letter))
            state = self._next(state, letter) if new is None else new
            if state == self.dead:
                return best
            hit = self.at_once[state]
            if hit and (best is None or hit < best):
                best = hit
        hit = self.at_end[state]
        return hit if hit and (best is None or hit < best) else best


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.automaton, self.seen = model, TermAutomaton(model.terms), {}

    def hit_words(self, text: bytes) -> dict[str, tuple[int, int]]:
        seen, hits = self.seen, {}
        for w in set(text.translate(WORD_TABLE).split()):
            try:
                hit = seen[w]
            except KeyError:
                if len(seen) > 150_000:
                    seen.clear()
                hit = seen[w] = self.automaton.match(w.decode("utf-8", "replace"))
            if hit:
                hits[w.decode("utf-8", "replace")] = hit
        return hits

    def spans(self, text: bytes) -> list[dict]:
        """Hits with their places (code points), term, edits and context score."""
        words = self.hit_words(text)
        if not words:
            return []
        plain = text.lower().decode("utf-8", "replace")
        return [
            {"start": m.start(), "end": m.end(), "edits": words[m[0]][0], "term": words[m[0]][1], "context": context(plain, m.start(), m.end())}
            for m in WORD.finditer(plain)
            if m[0] in words
        ]

    def uses(self, text: bytes) -> tuple[int, dict[tuple[int, int], float]]:
        """Number of words, and capped uses of each term and number of edits, weighed by their context."""
        return self.tally(text, self.spans(text))

    def tally(self, text: bytes, spans: list[dict]) -> tuple[int, dict[tuple[int, int], float]]:
        hits: dict[tuple[int, int], float] = {}
        for s in spans:
            key = s["term"], min(s["edits"], 2)
            hits[key] = min(USES, hits.get(key, 0.0) + s["context"])
        return len(text.translate(WORD_TABLE).split()) if hits else 0, hits

    def score(self, text: bytes, spans: list[dict] | None = None) -> float:
        """``spans``: those of the text, where they are known."""
        n_words, hits = self.tally(text, self.spans(text) if spans is None else spans)
        logit = sum(a * b for a, b in zip(self.model.weights, self.model.inputs(n_words, hits), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def context(text: str, start: int, end: int) -> float:
    """Below 1 for a quotation or a report, above 1 where the reader is addressed."""
    before, after = text[max(0, start - WINDOW_CHARS) : start].rpartition("\n")[2], text[end : end + WINDOW_CHARS].partition("\n")[0]
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after for q in QUOTES)
    near = WORD.findall(before)[-6:]
    if opened or not REPORTING.isdisjoint(near[-4:]):
        return QUOTED
    return ADDRESSED if not ADDRESSING.isdisjoint(near + WORD.findall(after)[:4]) else 1.0


def drawn(key: Column, share: float) -> Column:
    """True for about ``share`` of the keys, by their hash; fine enough for shares of a millionth and less."""
    return F.pmod(F.xxhash64(key), F.lit(10**15)) < int(share * 10**15)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """At most about ``max_docs`` labelled training rows (text, toxic), chosen by a hash of doc_id.  Their ids are
    broadcast (a few 100 KB at that bound), so that documents are not shuffled."""
    train = labels.where((crc_mod(F.col("doc_id"), 5) != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_docs / max(1, train.count()))
    ids = train.where(drawn(F.col("doc_id"), share))
    return stored(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic"), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Learn lexicon and evidence from labels alone; lang, source and doc_id are never looked at."""
    sample = labelled_sample(docs, labels, max_docs)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return Model()

    counted = stored(term_counts(sample), "toxicity-terms")
    words = counted.where("w = ''").first()
    model = Model(totals=(words["tp"] or 1, words["tn"] or 1))
    left, left_words, left_pos = counted, model.totals[0], pos
    for _ in range(ROUNDS):
        found = significant(left, (left_words, model.totals[1]), (left_pos, neg))
        fresh = [t for t in choose(found, (left_words, model.totals[1])) if t not in model.terms]
        if not fresh:
            break
        model.terms = sorted(model.terms + fresh)
        # What marks the toxic documents that the lexicon doesn't reach yet.
        missed = stored(unreached(sample.where("toxic = 1"), Model(model.terms)), "toxicity-missed")
        left_pos = missed.count()
        if left_pos < 3:
            break
        left = stored(term_counts(missed).select("w", "p", "tp").join(counted.select("w", "n", "tn"), "w"), "toxicity-terms")
        left_words = left.where("w = ''").first()["tp"] or 1
    return weigh(sample, model)


def term_counts(sample: DataFrame) -> DataFrame:
    """(w, p, n, tp, tn): number of toxic and other documents with each word (closed by $) or beginning, and of its uses
    there, at most ``USES`` a document.  The row of the empty word has the words of all documents."""

    def features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):  # bounds the counters
                yield from counts(batch.slice(at, DOCS_AT_ONCE))

    def counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        docs: tuple[Counter, Counter] = (Counter(), Counter())
        uses: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(column_bytes(batch, "text"), column_list(batch, "toxic"), strict=True):
            own: Counter = Counter()
            total = 0
            for w, n in Counter(text.translate(WORD_TABLE).split()).items():
                w = w.decode("utf-8", "replace")
                own[f"{w}$"] += n
                for k in PREFIX_LENGTHS:
                    if len(w) < k:
                        break
                    own[w[:k]] += n
                total += n
            docs[toxic].update(own.keys())
            uses[toxic].update({w: min(n, USES) for w, n in own.items()})
            uses[toxic][""] += total
        words = list({**uses[1], **uses[0]})
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            numbers = [pa.array([c[w] for w in part], pa.int64()) for c in (docs[1], docs[0], uses[1], uses[0])]
            yield pa.RecordBatch.from_arrays([pa.array(part), *numbers], ["w", "p", "n", "tp", "tn"])

    return sample.mapInArrow(features, "w string, p long, n long, tp long, tn long").groupBy("w").agg(*[F.sum(c).alias(c) for c in ("p", "n", "tp", "tn")])


def unreached(sample: DataFrame, model: Model) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in it:
            yield batch.filter(pa.array([all(e for e, _ in scorer.hit_words(x).values()) for x in column_bytes(batch, "text")], pa.bool_()))

    return sample.mapInArrow(run, sample.schema)


def significant(counted: DataFrame, words: tuple[int, int], docs: tuple[int, int]) -> dict[str, tuple[int, int]]:
    """Terms whose likelihood ratio against the rate in all words stands out among all that were tried."""
    p, n, rate = F.col("tp"), F.col("tn"), F.lit(words[0] / (words[0] + words[1]))
    ratio = 2 * (p * F.log(p / ((p + n) * rate)) + F.when(n > 0, n * F.log(n / ((p + n) * (1 - rate)))).otherwise(0.0))
    least = 2 * math.log(max(1_000, counted.count()) / 2)
    rows = counted.where("p >= 3 AND w != ''").withColumn("ratio", ratio)
    often = (p * words[1] > 6 * n * words[0]) & (F.col("p") * docs[1] > 4 * F.col("n") * docs[0])
    found = rows.where((F.col("ratio") >= least) & often).collect()  # words of the sample, whose rows are bounded
    return {r["w"]: (r["tp"], r["tn"]) for r in found}


def choose(found: dict[str, tuple[int, int]], words: tuple[int, int]) -> list[tuple[str, bool]]:
    """Of each family of beginnings the one with the highest ratio, on a tie the longest; the strongest terms first."""
    rate = words[0] / sum(words)

    def ratio(w: str) -> float:
        p, n = found[w]
        return p * math.log(p / (p + n) / rate) + (n * math.log(n / (p + n) / (1 - rate)) if n else 0.0)

    taken: set[str] = set()
    shorter: set[str] = set()  # beginnings of those taken
    out = []
    for w in sorted(found, key=lambda w: (-round(ratio(w), 6), -len(w), w)):
        if w not in shorter and not any(w[:k] in taken for k in range(1, len(w))):
            taken.add(w)
            out.append((w.rstrip("$"), not w.endswith("$")))
            shorter.update(w[:k] for k in range(1, len(w)))
    return out


def weigh(sample: DataFrame, model: Model) -> Model:
    """Counts of each term as spelled and with one and two edits, and the weights of the logistic model."""
    model.counts = [[(0, 0)] * 3 for _ in model.terms]

    def uses(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in it:
            rows = []
            for text, toxic in zip(column_bytes(batch, "text"), column_list(batch, "toxic"), strict=True):
                n_words, hits = scorer.uses(text)
                rows.append({"y": toxic, "n": n_words, "hits": [{"t": t, "e": e, "u": u} for (t, e), u in hits.items()]})
            yield pa.RecordBatch.from_pylist(rows, kind)

    kind = pa.schema([("y", pa.int64()), ("n", pa.int64()), ("hits", pa.list_(pa.struct([("t", pa.int64()), ("e", pa.int64()), ("u", pa.float64())])))])
    # As many rows as the sample's bound, with their hits.
    rows = [(r["y"], r["n"], {(h["t"], h["e"]): h["u"] for h in r["hits"]}) for r in sample.mapInArrow(uses, "y long, n long, hits array<struct<t:long,e:long,u:double>>").collect()]
    for y, _, hits in rows:
        for (t, e), u in hits.items():
            p, n = model.counts[t][e]
            model.counts[t][e] = (p + math.ceil(u), n) if y else (p, n + math.ceil(u))
    x = np.array([model.inputs(n, hits, y) for y, n, hits in rows])
    model.weights = logistic(x, np.array([float(y) for y, _, _ in rows]))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> list[float]:
    """Weights by Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def score_documents(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """doc_id, score, n_hits, n_quoted of each row, and on demand the hits with their places."""
    span = "array<struct<start:long,end:long,edits:long,term:long,context:double>>"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in it:
            texts = column_bytes(batch, "text")
            found = [scorer.spans(x) for x in texts]
            out = [
                batch.column(0),
                pa.array([scorer.score(x, spans) for x, spans in zip(texts, found, strict=True)], pa.float64()),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([sum(s["context"] < 1 for s in x) for x in found], pa.int64()),
            ]
            names = ["doc_id", "score", "n_hits", "n_quoted"]
            if with_spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()), ("term", pa.int64()), ("context", pa.float64())]))
                out.append(pa.array(found, kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(out, names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, score double, n_hits long, n_quoted long" + f", spans {span}" * with_spans
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns."""

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in it:
            yield batch.filter(pa.array([scorer.score(x) < threshold for x in column_bytes(batch, "text")], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
