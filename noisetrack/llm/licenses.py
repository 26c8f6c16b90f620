"""License scans: fuzzy search for short notices.

Texts are reduced to lower-case words.  A notice with at most k errors contains one of its k + 1 pieces unchanged
(pigeonhole), so an Aho-Corasick automaton over the pieces of all notices finds the candidate places; in a window around
each the regex library's bounded-error matching finds the best place, which is widened to whole words and verified again.
Words that tell licenses apart are marked in the notice: versions must be there exactly, names with one error at most (an
edited letter, or two neighbours in the wrong order), and nearer than the names of other licenses that could stand in their
place; on a tie the place has no label.  Of overlapping spans the one that explains most stays.  Phrases are found exactly
beside that.

Edge cases: null and empty texts have no words and no labels; repeated rows are scanned alike; whole texts are searched;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from noisetrack.llm.common import WORD_TABLE, column_bytes

#: Phrases searched exactly, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Notice:
    """``marked``: the text, with {words} that must be there exactly and {names~others} that may have one error and must be
    nearer than each of the others (separated by commas)."""

    marked: str
    label: str
    errors: int

    @property
    def text(self) -> str:
        return re.sub(r"\{([^}~]*)[^}]*\}", r"\1", self.marked)

    @property
    def keys(self) -> list[str]:
        return [k for k in re.findall(r"\{([^}]*)\}", self.marked) if "~" not in k]

    @property
    def names(self) -> list[tuple[str, list[str]]]:
        """Names with those of others."""
        found = [k.split("~") for k in re.findall(r"\{([^}]*~[^}]*)\}", self.marked)]
        return [(name, [x for x in others.split(",") if x]) for name, others in found]


#: Short notices, their labels and the errors (edited characters) that still count.
NOTICES = (
    Notice("released under the {mit~bsd,isc,gpl} license", "mit", 3),
    Notice("under the {mit~bsd,isc,gpl} license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 8),
    Notice("licensed under the {apache~} license version {2} 0", "apache-2", 4),
    Notice("{apache~} license version {2}", "apache-2", 2),
    Notice("licensed under the {gnu~} {general~} public license version {3}", "gpl-3", 4),
    Notice("licensed under the {gnu~} {general~} public license version {2}", "gpl-2", 4),
    Notice("{gnu~} {general~} public license version {3}", "gpl-3", 3),
    Notice("{gnu~} {general~} public license version {2}", "gpl-2", 3),
    Notice("{gnu~} {general~} public license", "gpl", 2),
    Notice("{gnu~} {lesser~} general public license", "lgpl", 3),
    Notice("{gnu~} {affero~} general public license", "agpl", 3),
    Notice("licensed under {cc by nc~cc by sa,cc by nd} 4 0", "cc-by-nc", 2),
    Notice("licensed under {cc by sa~cc by nc,cc by nd} 4 0", "cc-by-sa", 2),
    Notice("licensed under {cc by nd~cc by nc,cc by sa} 4 0", "cc-by-nd", 2),
    Notice("licensed under {cc by nc sa~cc by nc nd} 4 0", "cc-by-nc-sa", 2),
    Notice("licensed under {cc by nc nd~cc by nc sa} 4 0", "cc-by-nc-nd", 2),
    Notice("{cc by nc~cc by sa,cc by nd}", "cc-by-nc", 1),
    Notice("creative commons attribution {noncommercial~}", "cc-by-nc", 3),
    Notice("creative commons attribution {sharealike~}", "cc-by-sa", 3),
    Notice("creative commons attribution {noderivatives~}", "cc-by-nd", 3),
    Notice("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 8),
    Notice("under the {bsd~mit,isc,gpl} license", "bsd", 2),
    Notice("under the {isc~mit,bsd,gpl} license", "isc", 2),
    Notice("subject to the terms of the {mozilla~} public license v {2} 0", "mpl-2", 4),
    Notice("{mozilla~} public license version {2} 0", "mpl-2", 3),
    Notice("{mozilla~} public license", "mpl", 2),
    Notice("all rights reserved", "all-rights-reserved", 1),
)


class Name:
    """How far words are from holding a name: 0 exactly, 0.5 with other spaces, 1 with one error, ``FAR`` not at all."""

    FAR = 9

    def __init__(self, name: str) -> None:
        self.exact, self.joined = f" {name} ", name.replace(" ", "")
        self.swapped = [f" {name[:k]}{name[k + 1]}{name[k]}{name[k + 2 :]} " for k in range(len(name) - 1) if name[k] != name[k + 1]]
        self.one = regex.compile(f"(?: {regex.escape(name)} ){{e<=1}}")

    def distance(self, words: str) -> float:
        if self.exact in words:
            return 0
        if self.joined in words.replace(" ", ""):
            return 0.5
        return 1 if any(x in words for x in self.swapped) or self.one.search(words) else self.FAR


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length, with their places."""
    cuts = [round(i * len(text) / (errors + 1)) for i in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, phrases: dict[str, str], notices: tuple[Notice, ...]) -> None:
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices, self.texts = notices, [n.text for n in notices]
        self.pattern = [regex.compile(f"(?b)(?:{regex.escape(n.text)}){{e<={n.errors}}}") for n in notices]
        self.keys = [[f" {k} " for k in n.keys] for n in notices]
        self.names = [[(Name(k), [Name(x) for x in others]) for k, others in n.names] for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for offset, piece in pieces(notice.text, notice.errors):
                seeds.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def exact(self, norm: bytes) -> list[tuple[int, str]]:
        """(word, label) of each place of a phrase."""
        out = []
        for phrase, label in self.phrases:
            at, counted, words = norm.find(phrase), 0, -1
            while at >= 0:
                words += norm.count(b" ", counted, at + 1)  # each part of the text is counted once
                counted = at + 1
                out.append((words, label))
                at = norm.find(phrase, at + 1)
        return out

    def verified(self, number: int, norm: str, start: int, end: int) -> tuple[int, int, int, int] | None:
        """(notice, start, end, errors) of the best place in a window that holds as whole words with the notice's keys: the
        regex's best match widened to words, or else the best of the window's other spans of words."""
        m = self.pattern[number].search(norm, max(0, start), min(end, len(norm)))
        if not m:
            return None
        a, b = norm.rfind(" ", 0, m.start() + 1), norm.find(" ", max(m.end() - 1, m.start() + 1))
        errors = self.errors_of(number, norm[a : b + 1])
        if errors is not None:
            return number, a + 1, b, errors
        length, most = len(self.texts[number]), self.notices[number].errors
        edges = [i for i in range(max(0, start - 1), min(end + 1, len(norm))) if norm[i] == " "]
        spans = ((a, b) for a in edges for b in edges if abs(b - a - 1 - length) <= most)
        found = [(e, a, b) for a, b in spans if (e := self.errors_of(number, norm[a : b + 1])) is not None]
        if not found:
            return None
        errors, a, b = min(found)
        return number, a + 1, b, errors

    def errors_of(self, number: int, words: str) -> int | None:
        """Errors of a notice in whole words (with the spaces around), None if they are too many or its names aren't there."""
        whole = self.pattern[number].fullmatch(words[1:-1])
        return sum(whole.fuzzy_counts) if whole and self.named(number, words) else None

    def named(self, number: int, words: str) -> bool:
        """Whether the words have the notice's keys and names, and those rather than other names."""
        for name, others in self.names[number]:
            d = name.distance(words)
            if d == Name.FAR or any(x.distance(words) <= d for x in others):
                return False
        return all(k in words for k in self.keys[number])

    def fuzzy(self, norm: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) of the places in ``norm`` (words with single spaces between, before and behind)."""
        seen, found = set(), set()
        for last, (length, uses) in self.automaton.iter(norm):
            for number, offset in uses:
                start = last - length + 1 - offset
                if (number, start) not in seen:
                    seen.add((number, start))
                    k = self.notices[number].errors
                    found.add(self.verified(number, norm, start - k, start + len(self.texts[number]) + 2 * k))
        found.discard(None)
        return self.best(found)

    def best(self, found: set[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Of overlapping places the one with most letters explained, in the order of the text."""
        out: list[tuple[int, int]] = []
        kept = []
        for number, a, b, e in sorted(found, key=lambda x: (x[3] - len(self.texts[x[0]]), x[1], x[0])):
            at = bisect.bisect_left(out, (a, b))
            if (at == len(out) or out[at][0] >= b) and (at == 0 or out[at - 1][1] <= a):
                out.insert(at, (a, b))
                kept.append((number, a, b, e))
        return sorted(kept, key=lambda x: x[1])

    def scan(self, text: bytes) -> dict:
        words = text.translate(WORD_TABLE).split()
        norm = b" " + b" ".join(words) + b" "
        base = self.exact(norm)
        plain = norm.decode("utf-8", "replace")
        found = self.fuzzy(plain)
        starts = [m.start() for m in re.finditer(r"(?<= )[^ ]", plain)] if found else []
        spans = [
            {
                "label": self.notices[k].label,
                "first_word": bisect.bisect_left(starts, i),
                "last_word": bisect.bisect_left(starts, j) - 1,
                "errors": e,
                "likeness": 1 - e / len(self.texts[k]),
            }
            for k, i, j, e in found
        ]
        labels = {label for _, label in base}
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min((w for w, _ in base), default=None),
            "last_word": max((w for w, _ in base), default=None),
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {s["label"] for s in spans})),
            "score": 1.0 if base else max((s["likeness"] for s in spans), default=0.0),
            "spans": spans,
        }


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: counts and labels, and the verified spans in words."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int64()), ("likeness", pa.float64())])
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(span)}
        for batch in it:
            rows = [scanner.scan(x) for x in column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in kinds.items())], ["doc_id", *kinds])

    spans = "spans array<struct<label:string,first_word:long,last_word:long,errors:long,likeness:double>>"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, {spans}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
