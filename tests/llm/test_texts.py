import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from noisetrack.llm import fingerprints, language_model, licenses, packing, token_counts, toxicity
from noisetrack.llm.tokens import ByteTokens

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(2)
    terms = [("".join(rnd.choice("abc") for _ in range(rnd.randint(3, 10))), rnd.random() < 0.4) for _ in range(25)]
    terms = sorted(set(terms))
    automaton = toxicity.TermAutomaton(terms)
    for _ in range(3000):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
        best = []
        for k, (t, beginning) in enumerate(terms):
            d = min(edits(word[:i], t) for i in range(len(word) + 1)) if beginning else edits(word, t)
            if d <= toxicity.allowed_edits(t, beginning):
                best.append((d, k))
        got = automaton.match(word)
        assert (got is None) == (not best) and (not best or got[0] == min(best)[0])


def toxic_table(spark, n=400):
    rnd = random.Random(4)
    plain = [f"{a}{b}" for a in ("mo", "ta", "ri", "se", "lu") for b in ("na", "ko", "vel", "tis", "ram", "dor")]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(60)]
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["scoundrel", "nitwit", "grobe" + rnd.choice(plain)])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_samples_of_very_many_labels_are_not_empty(spark):
    ids = spark.range(40_000_000)
    assert 4 <= ids.where(toxicity.drawn(F.col("id"), 4e-7)).count() <= 40
    assert ids.limit(1000).where(toxicity.drawn(F.col("id"), 1.0)).count() == 1000


def test_toxicity_learns_words_beginnings_and_misspellings(spark, odd):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels)
    assert ("scoundrel", False) in model.terms and any(t.startswith("grob") and beginning for t, beginning in model.terms)
    score = toxicity.Scorer(model).score
    body = "mona riko sevel " * 5
    assert score((body + "you scoundrel nitwit " + body).encode()) > 0.5 and score((body + "you scoundrell nitwit " + body).encode()) > 0.5
    assert score(body.encode()) < 0.2 and score(b"") < 0.2
    assert score((body + 'he said "scoundrel" ' + body).encode()) < score((body + "you scoundrel " + body).encode())
    out = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [(out[r.doc_id].score >= 0.5) == bool(r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean(held) > 0.95
    kept = toxicity.reject_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.score_documents(odd, model, with_spans=True).count() == odd.count()
    empty = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score_documents(docs, empty).agg(F.max("score")).first()[0] == pytest.approx(0.1, abs=0.01)


def test_a_lexicon_of_many_terms_is_whole(spark):
    """No bound but that of the sample: hundreds of words that mark toxic rows are all terms, whatever their number."""
    coined = [f"{a}{b}{c}{d}gor" for a in "bdfk" for b in "aeiou" for c in "lmnr" for d in "aeiou"]
    rnd = random.Random(6)
    rows = [(i, " ".join(["mona", "riko", "sevel", "tulip"] * 6 + ([*rnd.sample(coined, 60)] if i % 2 else []))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    automaton = toxicity.TermAutomaton(model.terms)
    assert all(automaton.match(w) for w in coined) and not automaton.match("tulip")


def test_score_equals_the_model_written_out(spark):
    """The logistic model on evidence summed hit by hit, without tries and caches; other labels than 0 and 1 are ignored."""
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels.unionByName(spark.createDataFrame([(5, 1, 7)], labels.schema)))
    scorer = toxicity.Scorer(model)
    for r in docs.limit(80).collect():
        text = r.text
        uses = {}
        for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()):
            options = []
            for k, (term, beginning) in enumerate(model.terms):
                d = min(edits(m[0][:i], term) for i in range(len(m[0]) + 1)) if beginning else edits(m[0], term)
                if d <= toxicity.allowed_edits(term, beginning):
                    options.append((d, k))
            if options:
                d, k = scorer.automaton.match(m[0])
                assert d == min(options)[0] and (d, k) in options
                key = k, min(d, 2)
                uses[key] = min(toxicity.USES, uses.get(key, 0.0) + toxicity.context(text.lower(), m.start(), m.end()))
        total = sum(u * max(0.0, model.evidence(*key)) for key, u in uses.items())
        n = len(text.split()) if uses else 0
        x = [1.0, math.log1p(total), math.log1p(1000 * total / (n + 20)), float(bool(uses)), bool(uses) * math.log1p(n)]
        assert scorer.score(text.encode()) == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(model.weights, x, strict=True)))))


# ---------------------------------------------------------------- language model


def words_of(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), "\n"]


def test_language_model(spark, odd, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 500)
    rnd = random.Random(1)
    # Each word has two likely followers.
    follow = {k: rnd.sample(range(40), 2) for k in range(40)}
    rows = []
    for i in range(200):
        w, text = rnd.randrange(40), []
        for _ in range(rnd.randint(0, 40)):
            text.append(f"W{w}")
            w = rnd.choice(follow[w])
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in language_model.score_documents(df).collect()}
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(words_of(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words_of(t))
        assert got[i].base_score == pytest.approx(base) and got[i].n_tokens == len(words_of(t)) and got[i].train_tokens == n
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.8  # knows the followers
    assert len(language_model.score_documents(odd).collect()) == odd.count()
    assert language_model.score_documents(odd.limit(0)).count() == 0


def chained_texts(n, seed):
    rnd = random.Random(seed)
    follow = {k: rnd.sample(range(30), 2) for k in range(33)}
    out = []
    for i in range(n):
        w, text = rnd.randrange(30), []
        for _ in range(rnd.randint(0, 50)):
            text.append(f"w{w}")
            w = rnd.choice(follow[w]) if rnd.random() < 0.8 else rnd.randrange(33)
        out.append((i, " ".join(text)))
    return out


def brute_model(rows):
    """Counts, deleted interpolation weights by EM without bins, and the score of a text."""
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i, _ in rows}
    grams = lambda t: list(zip(["\n", *words_of(t)[:-1]], words_of(t), strict=True))
    words, pairs = Counter(), Counter()
    for i, t in rows:
        if fold[i]:
            words.update(words_of(t))
            pairs.update(grams(t))
    n, v = sum(words.values()), len(words)
    bucket = lambda c: min(int(math.log2(c)) + 1, 19) if c > 0 else 0
    seen = []
    for i, t in rows:
        if fold[i] == language_model.DEV_FOLD:
            own_w, own_p, length = Counter(words_of(t)), Counter(grams(t)), len(words_of(t))
            for h, w in grams(t):
                c_h = words[h] - own_w[h]
                seen.append((bucket(c_h), (pairs[h, w] - own_p[h, w]) / max(1, c_h), (words[w] - own_w[w]) / max(1, n - length), 1 / (v + 1)))
    weights = {b: [0.0, 0.6, 0.4] if b == 0 else [0.5, 0.3, 0.2] for b in range(20)}
    for _ in range(60):
        total = {b: [0.0] * 3 for b in weights}
        for b, *p in seen:
            share = [a * x for a, x in zip(weights[b], p, strict=True)]
            for k in range(3):
                total[b][k] += share[k] / sum(share)
        weights = {b: [(x + y) / (sum(total[b]) + (2e-3 if b == 0 else 3e-3)) for x, y in zip(total[b], (0.0 if b == 0 else 1e-3, 1e-3, 1e-3), strict=True)] if sum(total[b]) else weights[b] for b in weights}

    def score(t, weights=weights):
        return sum(math.log10(sum(a * x for a, x in zip(weights[bucket(words[h])], (pairs[h, w] / max(1, words[h]), words[w] / n, 1 / (v + 1)), strict=True))) for h, w in grams(t))

    return words, weights, score


@pytest.mark.parametrize("fan_out", [4096, 4])
def test_scores_equal_brute_force(spark, monkeypatch, fan_out):
    """Counts, known words, weights and scores, also where chunks ask in two steps."""
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 400)
    monkeypatch.setattr(language_model, "FAN_OUT", fan_out)
    monkeypatch.setattr(language_model, "UNIT_CHUNKS", 3)
    rows = chained_texts(300, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words, weights, score = brute_model(rows)
    learned, learn = [], language_model.learn_weights
    monkeypatch.setattr(language_model, "learn_weights", lambda *a: learned.append(learn(*a)) or learned[-1])
    got = {r.doc_id: r for r in language_model.score_documents(df).collect()}
    fixed = {b: list(learned[0][b]) for b in range(20)}
    for i, t in rows:
        assert got[i].n_known == sum(words[w] > 0 for w in words_of(t))
        assert got[i].score == pytest.approx(score(t, fixed))  # the same weights: exact
        assert got[i].score == pytest.approx(score(t), rel=0.02)  # weights learned without bins
    assert all(fixed[b] == pytest.approx(weights[b], abs=0.05) for b in weights)


def test_packed_arrays_round_trip():
    a = np.array([0, 1, 2**40, 2**64 - 1], np.uint64)
    assert (language_model.unpack(language_model.pack(a), "u8") == a).all() and len(language_model.unpack(language_model.pack(a[:0]), "u8")) == 0


# ---------------------------------------------------------------- licenses


def test_license_places_and_fuzzy_labels(documents, odd):
    texts = ["Released under the MIT License.", "x under the MIT license, under the mit-license", "Licensd under the Apache Licence, Version 2.0", "unter the mit license", "Licensed under CC BY-SA 4.0", "the mitten license of apaches", ""]
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (1, 1, 1, "mit")
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].n_words) == (2, 1, 5, 9)
    assert got[2].n_base == 0 and got[2].labels == "apache-2" and 0.9 < got[2].score < 1 and got[2].spans[0].errors == 2
    assert (got[2].spans[0].first_word, got[2].spans[0].last_word) == (0, 7) and (got[0].spans[0].first_word, got[0].spans[0].last_word) == (0, 4)
    assert got[4].labels == "cc-by-sa" and got[5].labels == "" and got[6].score == 0
    assert licenses.scan_licenses(odd).count() == odd.count()


def slow_places(scanner, norm):
    """Every span of whole words is held against every notice, without seeds and windows."""
    edges = [i for i, c in enumerate(norm) if c == " "]
    out = set()
    for number, notice in enumerate(scanner.notices):
        for x, a in enumerate(edges):
            for b in edges[x + 1 :]:
                if abs(b - a - 1 - len(notice.text)) <= notice.errors:
                    m = scanner.pattern[number].fullmatch(norm[a + 1 : b])
                    words = norm[a : b + 1]
                    if m and scanner.named(number, words):
                        out.add((number, a + 1, b, sum(m.fuzzy_counts)))
    return out


def test_fuzzy_search_equals_search_of_all_places():
    """Seeds, windows and widening lose no label, and every place found holds when all spans are tried."""
    rnd = random.Random(8)
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    for _ in range(150):
        text = []
        for _ in range(rnd.randint(1, 3)):
            notice = rnd.choice(licenses.NOTICES)
            letters = list(notice.text)
            for _ in range(rnd.randint(0, notice.errors + 1)):
                at, kind = rnd.randrange(len(letters)), rnd.random()
                if kind < 0.6:
                    letters[at] = rnd.choice("xqel ")
                elif kind < 0.8:
                    letters.insert(at, rnd.choice("xqel "))
                elif len(letters) > 1:
                    del letters[at]
            text += ["".join(letters), *rnd.choices(["lorem", "ipsum", "by", "version", "3", "license", "the"], k=rnd.randint(0, 3))]
        norm = " " + " ".join(" ".join(text).split()) + " "
        slow, fast = slow_places(scanner, norm), scanner.fuzzy(norm)
        labels = lambda found: {licenses.NOTICES[f[0]].label for f in found}
        assert all(f[1:3] in {s[1:3] for s in slow if s[0] == f[0]} for f in fast)
        assert labels(fast) == labels(scanner.best(slow)), norm


NEAR_MISSES = {
    "released under the BSD license": {"bsd"}, "released under the ISC license": {"isc"}, "released under the GPL license": set(), "released under the new license": set(),
    "licensed under the gnu general public license version 1": {"gpl"}, "licensed under the gnu general public license version 2": {"gpl-2"}, "gnu general public license version 3": {"gpl-3"},
    "gnu lesser general public license": {"lgpl"}, "apache license version 1 1": set(), "licensed under the Apache License, Version 1.1": set(), "licensed under the academic license version 2 0": set(),
    "subject to the terms of the mozilla public license version 1 1": {"mpl"}, "subject to the terms of the Mozilla Public License, v. 2.0": {"mpl-2"}, "cc by na": set(), "cc by sa": set(),
    "licensed under cc by nd 4 0": {"cc-by-nd"}, "licensed under cc by nc sa 4 0": {"cc-by-nc", "cc-by-nc-sa"}, "overall rights reserved": set(), "unter der mit lizenz": set(), "apache license version 21": set(),
}
MISSPELLED = {"under the mitt license": "mit", "under the mti license": "mit", "under the mi license": "mit", "cc by ncx": "cc-by-nc", "ccby nc": "cc-by-nc", "c by nc": "cc-by-nc", "available under the mit licence": "mit", "distributed undr the mit license": "mit", "the apache licence version 2": "apache-2", "cc by n c": "cc-by-nc"}


def test_near_misses_get_no_wrong_label_and_misspelled_phrases_theirs():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    for text, want in NEAR_MISSES.items():
        assert set(filter(None, scanner.scan(text.encode())["labels"].split(","))) == want, text
    for text, want in MISSPELLED.items():
        got = scanner.scan(text.encode())
        assert got["labels"] == want and got["score"] > 0.85 and got["n_base"] == 0, text
    both = scanner.scan(b" released undr the mit licence released under the mit license ")
    assert [(s["first_word"], s["last_word"], s["errors"]) for s in both["spans"]] == [(0, 4, 2), (5, 9, 0)]


def osa(a, b):
    """Edits from one to the other, neighbours in the wrong order being one."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@pytest.mark.parametrize("phrase,others", [("under the mit license", ["bsd", "isc", "gpl"]), ("apache license version 2", []), ("cc by nc", ["nd", "sa"])])
def test_recall_of_misspelled_phrases(phrase, others):
    """One edited letter anywhere; where another name is as near, or a version changes, no label is right."""
    rnd, scanner = random.Random(2), licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    name = {"under the mit license": "mit", "apache license version 2": "2", "cc by nc": "nc"}[phrase]
    at, letters, found, clear = phrase.index(name), "abcdefghijklmnopqrstuvwxyz", 0, 0
    for _ in range(600):
        k, kind = rnd.choice([i for i, c in enumerate(phrase) if c != " "]), rnd.randrange(3)
        text = phrase[:k] + ("", rnd.choice(letters), rnd.choice(letters) + phrase[k])[kind] + phrase[k + 1 :]
        if text == phrase:
            continue
        slot = text[at : len(text) - (len(phrase) - at - len(name))]  # what became of the name, if the edit is not before it
        if k >= at and (name == "2" or any(osa(slot, x) <= osa(slot, name) for x in others)):
            continue
        clear += 1
        found += licenses.PHRASES[phrase] in scanner.scan(f"lorem {text} ipsum".encode())["labels"].split(",")
    assert clear > 300 and found >= 0.95 * clear, (found, clear)


def test_base_places_equal_brute_force(documents):
    rnd = random.Random(5)
    parts = ["under", "the", "mit", "license", "MIT", "apache", "License", "version", "2", "cc", "by", "nc", "under the mit license", "Apache License, Version 2", "cc-by-nc", "é", "_", "\n", "x2"]
    rows = [(i, rnd.choice(["", " ", "-"]).join(rnd.choices(parts, k=rnd.randint(0, 30))) if i else None) for i in range(120)]
    rows += [(i + 200, " ".join(rnd.choices(parts, k=rnd.randint(0, 40)))) for i in range(120)]
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(rows)).collect()}
    hits = 0
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        r, at = got[i], [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        hits += len(places)
    assert hits > 100


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_differencing_partitions_all_items():
    rnd = random.Random(3)
    for n, k in ((1, 1), (5, 3), (40, 7), (300, 40)):
        sizes = [rnd.randint(1, 256) for _ in range(n)]
        sums, of = packing.difference(sizes, k)
        assert len(of) <= k and sorted(i for w in of for i in w) == list(range(n)) and sums == [sum(sizes[i] for i in w) for w in of]
    windows = packing.pack_windows([rnd.randint(1, 256) for _ in range(2000)])
    assert windows and packing.pack_windows([]) == [] and packing.pack_windows([2048, 2048]) == [[0], [1]]


def test_packing_places_every_token_once(documents, odd, reference):
    rows = [(i, "some words <|endoftext|> here " * (i * 7 % 50)) for i in range(120)]
    for df in (documents(rows), odd):
        out = packing.pack_documents(df).collect()
        total, texts = Counter(), {}
        for r in df.collect():
            ids = np.array([*reference.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
            texts.setdefault(r.doc_id, []).append(ids)
            total[r.doc_id] += len(ids)
        placed = Counter()
        for p in out:
            placed[p.doc_id] += p.length
            assert any(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and len(ids) == p.doc_tokens for ids in texts[p.doc_id])
        assert placed == total
        by = {}
        for p in out:
            by.setdefault(p.sequence_id, []).append((p.offset, p.length))
        for pieces in by.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 2048
    assert packing.pack_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_equal_offsets(documents, odd, reference, rule):
    rows = [(1, "One line.\n\nAnother  line \n\n\n last"), (2, ""), (3, "日本語\nテスト 🙂🙂\n")]
    df = documents(rows)
    got = {}
    for r in token_counts.count_tokens(df, rule=rule).collect():
        got.setdefault(r.doc_id, []).append(r)
    for r in df.collect():
        parts = [f"{r.source}\n", f"{r.lang}\n", *token_counts.split_lines(r.text)]
        sections = sorted(got[r.doc_id], key=lambda s: s.section)
        assert [s.n_bytes for s in sections] == [len(p.encode()) for p in parts]
        n = len(reference.encode("".join(parts), add_special_tokens=False).ids)
        assert sum(s.n_tokens for s in sections) == pytest.approx(n) and all(s.doc_tokens == n for s in sections)
    assert token_counts.count_tokens(odd, rule=rule).select("doc_id").distinct().count() == 10


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_tokens_go_to_the_sections_that_brute_force_gives(documents, reference, rule):
    """Each token's byte span is held against each section's, byte by byte."""
    rnd = random.Random(9)
    pieces = ["word", " ", "\n", "\n\n", "日本", "🙂", "    ", "re", "\t", "É", "x.y", "1234"]
    rows = [(i, "".join(rnd.choices(pieces, k=rnd.randint(0, 60)))) for i in range(60)]
    df = documents(rows)
    bytes_of = {rank: piece for piece, rank in ByteTokens().ranks.items()}
    got = {}
    for r in token_counts.count_tokens(df, rule=rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.n_tokens, r.n_crossing)
    crossing = 0
    for r in df.collect():
        parts = [f"{r.source}\n", f"{r.lang}\n", *token_counts.split_lines(r.text)]
        owner = [k for k, part in enumerate(parts) for _ in part.encode()]
        want, at = {k: [0.0, 0] for k in range(len(parts))}, 0
        for i in reference.encode("".join(parts), add_special_tokens=False).ids:
            own = owner[at : at + len(bytes_of[i])]
            at += len(own)
            shares = Counter(own)
            if rule == "share":
                for k, n in shares.items():
                    want[k][0] += n / len(own)
            else:
                want[own[0] if rule == "start" else max(shares, key=lambda k: (shares[k], -k))][0] += 1
            want[own[0]][1] += len(shares) > 1
            crossing += len(shares) > 1
        assert at == len(owner)
        assert {k: (pytest.approx(a), b) for k, (a, b) in want.items()} == got[r.doc_id]
    assert crossing > 20


def test_allocation_rules():
    lengths, ends = np.array([2, 4, 1]), np.array([3, 3, 7])  # the second token has one byte in the first section and three in the third
    assert token_counts.allocate(lengths, ends, "start")[0].tolist() == [2, 0, 1]
    assert token_counts.allocate(lengths, ends, "most")[0].tolist() == [1, 0, 2]
    assert token_counts.allocate(lengths, ends, "share")[0].tolist() == [1.25, 0, 1.75]
    assert token_counts.allocate(lengths, ends, "start")[1].tolist() == [1, 0, 0]


# ---------------------------------------------------------------- fingerprints


def test_fingerprints_of_next_documents(documents, odd):
    rnd = random.Random(6)
    rows = [(i * 3, " ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randint(0, 120)))) for i in range(90)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(documents(rows).repartition(3)).collect()}
    order = sorted((i for i, _ in rows), reverse=True)
    text = dict(rows)
    likes = []
    for k, i in enumerate(order):
        following = text[order[(k + 1) % len(order)]]
        half = len(text[i]) // 2
        changed = text[i][: len(text[i]) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(text[i])
        likes.append(got[i].near_edited >= got[i].near_next)
    assert np.mean(likes) > 0.9
    assert fingerprints.fingerprint_documents(odd).count() == odd.count()
    assert fingerprints.fingerprint_documents(odd.limit(0)).count() == 0
    one = fingerprints.fingerprint_documents(documents([(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()  # its own next


def brute_print(text):
    """256 votes, one bit at a time."""
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    words = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0d]+", text.translate(LOWER))]
    pairs = [mix((a * 0x9E3779B97F4A7C15 + b) & mask) for a, b in zip(words, words[1:], strict=False)] or words
    votes, total = [0.0] * 256, 0.0
    for term, n in Counter(pairs).items():
        weight = np.float32(1 + np.log(n))
        total += float(weight)
        for step in range(4):
            word = mix((term + mix((step + 1) * 0x9E3779B97F4A7C15 & mask)) & mask)
            for k, byte in enumerate(word.to_bytes(8, "little")):
                for b in range(8):
                    votes[step * 64 + k * 8 + b] += float(weight) * (byte >> 7 - b & 1)
    return [2 * v > total for v in votes]


def test_fingerprints_and_groups_equal_brute_force(documents):
    rnd = random.Random(11)
    base = [[f"W{rnd.randrange(400)}" for _ in range(rnd.randint(2, 150))] for _ in range(25)]
    rows = []
    for i in range(75):
        text = list(base[i % 25])
        for _ in range(i // 25):
            text[rnd.randrange(len(text))] = "new"
        rows.append((i, " ".join(text)))
    rows += [(100, ""), (101, None), (102, "word")]
    table = {r.doc_id: r for r in fingerprints.fingerprint_table(documents(rows)).collect()}
    order = sorted((i for i, _ in rows), reverse=True)
    texts = {i: t or "" for i, t in rows}
    bits = {i: brute_print(t) for i, t in texts.items()}
    value = {i: sum(1 << (255 - k) for k, b in enumerate(bits[i]) if b) for i in texts}
    for k, i in enumerate(order):
        following = order[(k + 1) % len(order)]
        half = len(texts[i]) // 2
        changed = brute_print(texts[i][: len(texts[i]) - half] + texts[following][:half])
        alike = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / 256
        assert bytes(table[i].fp) == value[i].to_bytes(32, "big")
        assert table[i].near_edited == pytest.approx(alike(bits[i], changed)) and table[i].near_next == pytest.approx(alike(bits[i], bits[following]))
    # Groups: the smallest fingerprint reached in steps of the radius.
    group = {v: v for v in value.values()}
    for _ in group:
        group = {v: min(group[w] for w in group if (v ^ w).bit_count() <= fingerprints.RADIUS) for v in group}
    assert {i: int.from_bytes(table[i].near_group, "big") for i in texts} == {i: group[value[i]] for i in texts}
    assert len(set(group.values())) < len(group)


def test_text_ids_and_rows_without_ids(spark):
    rows = [("b", "one two"), ("a", "three four"), (None, "five six"), (None, "five six"), ("c", "seven eight")]
    got = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    by = {(r.doc_id, r.edited_sha256) for r in got}
    sha = lambda a, b: hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest()
    assert by == {("c", sha("seven eight", "one two")), ("b", sha("one two", "three four")), ("a", sha("three four", "five six")), (None, sha("five six", "five six")), (None, sha("five six", "seven eight"))}


def test_within_radius(spark):
    rows = [bytes(32), bytes(31) + b"\x0f", b"\xff" * 32]
    got = {bytes(r.fp): bytes(r.near_group) for r in fingerprints.within_radius(spark.createDataFrame([(bytearray(x),) for x in rows], "fp binary")).collect()}
    assert got == {rows[0]: rows[0], rows[1]: rows[0], rows[2]: rows[2]}
