import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from noisetrack.llm import exact_dedup, hamming, simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_duplicates_of_odd_rows(odd):
    rows = exact_dedup.find_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in odd.collect():
        by.setdefault((r.text or "").translate(LOWER), []).append(r.doc_id)
    for r in rows:
        ids = next(v for k, v in by.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256 and (r.doc_id in v))
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None) and r.kept == (r.doc_id == r.keep_id)
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(by)


def test_smallest_id_may_stay(documents):
    rows = exact_dedup.find_duplicates(documents([(1, "A"), (2, "a"), (3, "b")]), keep="min").collect()
    assert {(r.doc_id, r.keep_id) for r in rows} == {(1, 1), (2, 1), (3, 3)}


def test_collisions_are_told_apart(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("same"))
    rows = exact_dedup.find_duplicates(documents([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")])).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows} == {(1, 3, 2), (3, 3, 2), (2, 4, 2), (4, 4, 2), (5, 5, 1)}


def test_many_groups_are_joined_by_a_shuffle_without_texts(odd, monkeypatch, spark):
    key = lambda r: tuple(map(str, r))
    few = sorted(exact_dedup.find_duplicates(odd).collect(), key=key)
    monkeypatch.setattr(exact_dedup, "BROADCAST_GROUPS", 0)
    assert sorted(exact_dedup.find_duplicates(odd).collect(), key=key) == few
    assert exact_dedup.drop_duplicates(odd).count() == len({(r.text or "").translate(LOWER) for r in odd.collect()})


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x", "h", 2), (2, "x", "g", 3)], "doc_id long, text string, hash string, group_size int")
    assert [r.asDict() for r in exact_dedup.drop_duplicates(df).collect()] == [{"doc_id": 2, "text": "x", "hash": "g", "group_size": 3}]
    assert exact_dedup.find_duplicates(df.limit(0)).count() == 0


def brute_fingerprint(text, size=3):
    words = (text or "").translate(LOWER).split()
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, radius):
    ids = list(fps)
    parent = {i: i for i in ids}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_texts(n, seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 200))] for _ in range(n // 3)]
    out = []
    for i in range(n):
        text = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 8])):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        out.append((i, " ".join(text)))
    return [*out, (n, ""), (n + 1, None)]


def test_near_groups_equal_brute_force(documents):
    rows = near_texts(150, 3)
    got = {r.doc_id: r for r in simhash_dedup.near_groups(documents(rows)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    assert {i: r.fp.hex() for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_groups(fps, 3)


@pytest.mark.parametrize("radius,equal,tile", [(0, 1, 2048), (3, 2, 2048), (3, 1, 7), (6, 1, 5)])
def test_links_lose_no_pair(spark, monkeypatch, radius, equal, tile):
    """Also in buckets that are split into tiles."""
    monkeypatch.setattr(hamming, "TILE", tile)
    rnd = random.Random(radius)
    center = [rnd.getrandbits(64) for _ in range(4)]
    fps = {f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for f in center for _ in range(25)}
    df = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in fps], "fp binary")
    found = hamming.components(hamming.links(hamming.block_keys(df, 64, radius, equal), 64, radius)).collect()
    root = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in found}
    assert {f: root.get(f, f) for f in fps} == brute_groups({f: f for f in sorted(fps)}, radius)


def test_bit_sliced_pairs_equal_popcount():
    rnd = np.random.RandomState(1)
    rows = rnd.randint(0, 256, (300, 8)).astype(np.uint8)
    rows[1::3] = rows[0::3] ^ np.eye(8, dtype=np.uint8)[rnd.randint(0, 8, 100)]
    keys = np.repeat(np.arange(30), 10)
    got = {(int(a), int(b)) for i, j in hamming.Lanes(keys, rows, 3).pairs() for a, b in zip(i, j, strict=True)}
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if keys[a] == keys[b] and np.bitwise_count(rows[a] ^ rows[b]).sum() <= 3}
    assert got == want and want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in hamming.components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def similarity(a, b):
    s = [{tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for t in (a, b)]
    return len(s[0] & s[1]) / len(s[0] | s[1])


def test_similar_documents_are_dropped_and_others_kept(documents):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(2000)]
    base = [[rnd.choice(words) for _ in range(300)] for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(base)]
    for i, t in enumerate(base[:20]):
        t = list(t)
        for _ in range(4):
            t[rnd.randrange(300)] = "edited"
        rows.append((100 + i, " ".join(t)))
    half = [(200 + i, " ".join(base[i][:150] + [rnd.choice(words) for _ in range(150)])) for i in range(20, 30)]  # share a passage
    assert all(similarity(rows[i][1], rows[30 + i][1]) >= 0.8 for i in range(20))
    kept = {r.doc_id for r in simhash_dedup.drop_near_duplicates(documents(rows + half)).collect()}
    assert kept == set(range(30)) | {200 + i for i in range(20, 30)}


def line_texts(seed, times, fresh=False):
    """Texts of 100 words (the same, or ``fresh`` ones each) and one 7-word line, repeated."""
    rnd = random.Random(seed)
    body = [f"w{rnd.getrandbits(40)}" for _ in range(100)]
    return [" ".join(([f"w{rnd.getrandbits(40)}" for _ in range(100)] if fresh else body) + "no entry in this column of it".split() * n) for n in times]


def test_unrelated_texts_with_a_much_repeated_line_stay(documents):
    texts = [t for n in (40, 60, 100, 200) for t in line_texts(n, [n] * 3, fresh=True)]
    assert max(similarity(a, b) for k, a in enumerate(texts) for b in texts[k + 1 :]) < 0.1
    kept = {r.doc_id for r in simhash_dedup.drop_near_duplicates(documents(list(enumerate(texts)))).collect()}
    assert kept == set(range(len(texts)))


def brute_kept(rows, least=0.8):
    words = {i: t.split() for i, t in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i for i in sets if root(i) == i}


def test_near_copies_that_repeat_a_line_differently_are_dropped(documents):
    texts = [t for seed in range(12) for t in line_texts(seed, [1, 5, 10, 40])]
    rows = list(enumerate(texts))
    want = brute_kept(rows)
    assert len(want) == 12
    assert {r.doc_id for r in simhash_dedup.drop_near_duplicates(documents(rows)).collect()} == want


def family(n, words, edits, seed):
    """Near copies of one text, of ``edits`` (least, most) edited words each."""
    rnd = random.Random(seed)
    base = [f"w{rnd.getrandbits(40)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for k in rnd.sample(range(words), rnd.randint(*edits)):
            text[k] = f"w{rnd.getrandbits(40)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("tile", [512, 20])
def test_large_families_equal_brute_force(documents, monkeypatch, tile):
    """Every pair that brute force over all pairs links is linked, also in buckets well over 32 rows, where pairs of the
    closest forest fail the check, and in tiles."""
    monkeypatch.setattr(hamming, "CLOSE_TILE", tile)
    monkeypatch.setattr(simhash_dedup, "CLOSE_TILE", tile)
    texts = family(300, 300, (2, 8), 1) + family(40, 300, (2, 8), 2)
    rows = list(enumerate(texts))
    assert {r.doc_id for r in simhash_dedup.drop_near_duplicates(documents(rows)).collect()} == brute_kept(rows)


def test_joining_pairs_leave_none_open():
    rnd = np.random.RandomState(2)
    sets = [np.unique(np.concatenate([np.arange(40), rnd.randint(100, 130, 6)])).astype(np.int64) for _ in range(60)]
    fps, labels = np.zeros((60, 8), np.uint8), np.arange(60) // 2
    like = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.85
    parent = {i: i // 2 * 2 for i in range(60)}
    for a, b in [(i, j) for i in range(60) for j in range(i) if like(sets[i], sets[j])]:
        parent = {k: parent[b] if v == parent[a] else v for k, v in parent.items()}
    joined = {i: i // 2 * 2 for i in range(60)}
    for a, b in simhash_dedup.joining_pairs(labels, fps, sets, 0, 0.85):
        assert joined[a] != joined[b] and like(sets[a], sets[b])
        joined = {k: joined[b] if v == joined[a] else v for k, v in joined.items()}
    assert len(set(joined.values())) == len(set(parent.values()))


def test_near_duplicates_of_odd_rows(odd):
    out = simhash_dedup.drop_near_duplicates(odd)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == odd.columns and {1, 4, 6, 8, 9} <= set(ids) and not {2, 3, 5, 7} & set(ids) and ids.count(4) == 1
    assert simhash_dedup.near_groups(odd).count() == odd.count()
    assert simhash_dedup.drop_near_duplicates(odd.limit(0)).count() == 0


def test_columns_may_have_any_name(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, text, 5, "x", "y", 0), (2, text, 6, "x", "y", 1), (3, "other words altogether", 7, "x", "y", 2)], "doc_id long, text string, _id long, _lost string, fp string, component_id long")
    assert [(r.doc_id, r._id, r._lost) for r in simhash_dedup.drop_near_duplicates(df).orderBy("doc_id").collect()] == [(1, 5, "x"), (3, 7, "x")]
    assert simhash_dedup.drop_near_duplicates(df).columns == df.columns


def test_keys_grow_with_the_number_of_fingerprints():
    from noisetrack.llm import fingerprints

    found = [fingerprints.equal_blocks(n, 12) for n in (0, 10**6, 10**9, 10**13)]
    assert found == [1, 1, 2, 3]
