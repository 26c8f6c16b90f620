"""Spelling variants, quality rules and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisetrack.llm import conversations, quality_rules, queries, variants

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- spelling variants


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows):
    uses = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            uses[run] += 1
    words = {w: n for w, n in uses.items() if len(w) >= 6 and n >= 5}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    out, form = {}, {}
    for w, n in words.items():
        near = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if is_near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
        out[w] = len(near)

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, out[w], words[form[w]] if form[w] else None) for w, n in words.items()}


def as_rows(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("node_words", [4_000, 20])
def test_variants_equal_all_pairs(spark, monkeypatch, node_words):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(variants.near_words, "__defaults__", (node_words,))
    monkeypatch.setattr(variants, "DAMAGE", 199)
    assert as_rows(variants.group_variants(docs)) == plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_variants_follow_forms_to_the_root(spark, documents):
    counts = {"abcdefgh": 600, "abcdefgx": 100, "abcdefyx": 20, "abcdezyx": 4, "bcdefgh": 5, "Éabcdef": 6, "Éabcdeg": 6}
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items(), 10**6)] + [(1, None), (2, ""), (None, "short words"), (3, "zz" * 20_000)]
    got = as_rows(variants.group_variants(documents(rows)))
    assert got == plain_variants(rows)
    assert {w: r for w, _, r, *_ in got}["abcdefyx"] == "abcdefgh"


def test_variants_of_nothing(spark, documents, odd):
    assert variants.group_variants(documents([])).count() == 0
    twice = odd.withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert as_rows(variants.group_variants(twice)) == plain_variants([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_one_edit_is_one_edit():
    draw = random.Random(3)
    words = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 5))) for _ in range(300)]
    assert all(variants.one_edit(a, b) == (a != b and is_near(a, b)) for a in words for b in words)


# ---------------------------------------------------------------- quality rules


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[w] > 1:
            repeated |= {k, k + 1, k + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


def test_statistics_equal_plain_ones(spark, odd):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [r["text"] or "" for r in odd.collect()] + ["a a a a", "a b c a b c", "x\x0b\x0cy\x1cz\xa0w v", "a\n\na\n a\na", "#*$%&|<> é🙂"]
    assert [quality_rules.statistics(t.encode())[:5] for t in texts] == [plain_statistics(t) for t in texts]


def test_query_holds_its_contract_and_learns(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op12_quality_rules(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    right = held = 0
    for r in rows:
        n_words, chars, symbols, lines, repeated = plain_statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n_words, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] in quality and not r["base_failed"]:
            held, right = held + 1, right + (r["kept"] == bool(quality[r["doc_id"]]))
    assert held > 30 and right >= 0.97 * held


def test_list_covers_in_order():
    draw = np.random.default_rng(1)
    n = 4_000
    x = {k: draw.random(n) for k in ("a", "b", "c")}
    bad = (x["a"] > 0.8) & (x["b"] <= 0.5) | (x["c"] > 0.95)
    rules = quality_rules.decision_list(x, bad, np.arange(n) % 4 == 0)
    held = np.logical_or.reduce([quality_rules.covers(r, x) for r in rules])
    assert len(rules) >= 2 and (held == bad).mean() > 0.99
    assert quality_rules.decision_list(x, np.zeros(n, bool), np.arange(n) % 4 == 0) == []
    noise = draw.random(n) < 0.1
    assert quality_rules.decision_list(x, noise, np.arange(n) % 4 == 0) == []  # pruned away


def test_expression_equals_rules(spark, documents):
    rules = [(quality_rules.Condition("words", False, 60.0), quality_rules.Condition("symbols_a_word", True, 0.1)), (quality_rules.Condition("digits_a_char", True, 0.5),)]
    rows = [(1, "word " * 55), (2, "word# " * 55), (3, " ".join(str(k * 7919) for k in range(80))), (4, None), (5, "a")]
    got = {r["doc_id"]: (r["rule"], r["base_failed"]) for r in quality_rules.judge(documents(rows), rules).collect()}
    assert got == {1: (0, True), 2: (1, True), 3: (2, False), 4: (0, True), 5: (0, True)}
    assert "CASE" in str(quality_rules.verdict(rules)).upper() or len(rules) == 2


def test_quality_edge_cases(spark, documents, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.learn(odd, labels) == []
    assert quality_rules.judge(odd, []).count() == odd.count()
    assert quality_rules.judge(documents([]), []).count() == 0
    clash = odd.withColumns({"n_words": F.lit("x"), "_row": F.lit(1), "kept": F.lit(2)})
    kept = quality_rules.keep_good(clash, [])
    assert kept.columns == clash.columns and {r["doc_id"] for r in kept.collect()} <= {6, 7}


# ---------------------------------------------------------------- conversations

STATES = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest(rows):
    """(cost, audit, lines) by trying every edit; rows: (role, text, fault)."""

    @cache
    def best(i, q, put):
        found = []
        if i == len(rows) and q in "EA":
            found.append((0, "", ()))
        if put < 3:
            for c, role in (("u", "user"), ("a", "assistant")):
                if (q, c) in STATES:
                    cost, audit, lines = best(i, STATES[q, c], put + 1)
                    found.append((cost + 5, "I" + audit, (f"{role}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = best(i + 1, q, 0)
            found.append((cost + 2, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (q, role[:1]) in STATES:
                    cost, audit, lines = best(i + 1, STATES[q, role[:1]], 0)
                    found.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                for c, new in (("u", "user"), ("a", "assistant")):
                    if (q, c) in STATES:
                        cost, audit, lines = best(i + 1, STATES[q, c], 0)
                        found.append((cost + 1 + more, "R" + audit, (f"{new}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from the end on, so that no call goes deep
        for put in (3, 2, 1, 0):
            for q in "ESUA":
                best(i, q, put)
    return best(0, "E", 0)


def plain_repair(table, damage=True):
    """table: (conv_id, turn, role, text) -> results by conversation."""
    after = defaultdict(list)
    for conv, turn, role, text in table:
        after[conv]  # noqa: B018  every conversation has a result
        some = lambda x: " " if x is None else str(x)
        role, text = some(role), some(text)
        kind = zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20 if damage else 99
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in after.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest(tuple((r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def by_conversation(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"


def invented(n, longest, seed=5):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Well.  ", "so", None, "é "]
    rows = []
    for conv in range(n):
        turn = draw.randint(0, 3)
        for _ in range(draw.randint(1, longest)):
            rows.append((conv, None if draw.random() < 0.05 else turn, draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "aux"]), draw.choice(texts) if draw.random() < 0.6 else f"text {draw.random()}."))
            turn += draw.choice([0, 1, 1, 1, 2])
    draw.shuffle(rows)
    return rows


def test_repair_of_the_table(spark):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert by_conversation(queries.op13_conversation_repair(spark, "/root/testdata/sf0.01")) == plain_repair(table)


@pytest.mark.parametrize("segment", [1, 3, 2_000])
def test_repair_equals_every_edit_tried(spark, segment):
    table = invented(60, 14)
    rows = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert by_conversation(conversations.repair(conversations.damaged(rows), segment, ranges=6)) == plain_repair(table)


def test_repair_of_one_long_conversation(spark):
    table = [(7, t, *r[2:]) for t, r in enumerate(invented(40, 12, seed=9))] + [(8, 0, "user", "Hi."), (None, 1, "user", "Hi."), (None, None, None, None)]
    rows = spark.createDataFrame(table, SCHEMA)
    assert by_conversation(conversations.repair(conversations.intact(rows), 16, ranges=5)) == plain_repair(table, damage=False)


def test_repair_edge_cases(spark):
    assert conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    table = [(1, 1, "user", "word " * 50_000 + "."), (2, None, None, None), (2, None, None, None), (3, 4, "user", "Hi."), (3, 4, "user", "Hi.")]
    rows = spark.createDataFrame([(*r, 1, 2) for r in table], SCHEMA + ", copies long, part long")
    assert by_conversation(conversations.repair(conversations.damaged(rows))) == plain_repair(table)
    words = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert by_conversation(conversations.repair(conversations.damaged(words))) == plain_repair([tuple(r) for r in words.collect()])


def test_block_tables_equal_single_rows():
    auto, draw = conversations.tables(), random.Random(1)
    for _ in range(300):
        symbols = bytes(draw.randrange(9) for _ in range(draw.randint(0, 23)))
        v = w = draw.randrange(len(auto.vectors))
        total = 0
        for s in symbols[::-1]:
            total += int(auto.added[s, w])
            w = int(auto.step[s, w])
        step, added = auto.mapping(symbols)
        assert (int(step[v]), int(added[v])) == (w, total)
