import base64
import gzip
import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from noisetrack.llm import mixing, queries, warc

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in got.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, df.select(*names).toPandas().itertuples(index=False, name=None))) == sorted(map(repr, got.df().itertuples(index=False, name=None)))


def cells_of(spark, seed, n=(6, 3, 3), most=1000):
    rnd = random.Random(seed)
    rows = [(f"s{a}", f"l{b}", f"t{c}", float(rnd.randint(1, most))) for a in range(n[0]) for b in range(n[1]) for c in range(n[2])]
    return rows, spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")


def water(tokens, share, budget):
    """Targets by bisection: min(tokens, level * share) that add up to the budget."""
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(t, mid * s) for t, s in zip(tokens, share, strict=True)) < budget else (low, mid)
    return [min(t, low * s) for t, s in zip(tokens, share, strict=True)]


@pytest.mark.parametrize("seed,most", [(1, 1000), (2, 5), (3, 100_000)])
def test_raking_meets_the_marginals_at_the_default_settings(spark, seed, most):
    rows, cells = cells_of(spark, seed, most=most)
    raked = mixing.rake(cells)
    assert mixing.residual(raked).first()[0] <= mixing.TOLERANCE
    got = raked.collect()
    assert len(got) == len(rows) and all(0 <= r.weight <= r.tokens * (1 + 1e-12) for r in got)
    for at, dim in enumerate(mixing.DIMENSIONS):
        plain = {}
        for r in rows:
            plain[r[at]] = plain.get(r[at], 0.0) + r[3]
        want = dict(zip(plain, water(plain.values(), [t ** mixing.FLATTEN[dim] for t in plain.values()], mixing.KEEP * sum(plain.values())), strict=True))
        for v, t in want.items():
            assert sum(r.weight for r in got if r[dim] == v) == pytest.approx(t, abs=mixing.TOLERANCE * mixing.KEEP * sum(plain.values()) * 1.01)
    kept = mixing.keep_probabilities(raked)
    assert kept.agg(F.sum(F.col("tokens") * F.col("keep_prob"))).first()[0] == pytest.approx(mixing.KEEP * sum(r[3] for r in rows), rel=1e-3)


def test_small_sources_are_kept_whole_and_the_rest_is_dealt_to_others(spark):
    rows = [("a", "l", "t", 10.0), ("b", "l", "t", 1000.0), ("c", "l", "t", 1000.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    got = {r.source: r.weight for r in mixing.rake(cells, {"source": 0.0, "lang": 1.0, "topic": 1.0}, keep=0.5, tolerance=1e-9).collect()}
    assert got["a"] == pytest.approx(10) and got["b"] == pytest.approx(497.5) and got["c"] == pytest.approx(497.5)


def test_marginals_that_no_weights_meet_are_reported(spark):
    rows = [("a", "x", "t", 100.0), ("b", "y", "t", 300.0)]  # source and language are the same, their targets are not
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    assert mixing.residual(mixing.rake(cells, {"source": 0.0, "lang": 1.0, "topic": 1.0}, keep=0.4, rounds=30)).first()[0] > 0.05


def test_mixing_of_odd_rows(odd):
    out = mixing.decide(odd)
    assert out.count() == odd.count()
    kept = mixing.sample_documents(odd)
    assert kept.columns == odd.columns and mixing.sample_documents(odd.limit(0)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archive_round_trip(spark, tmp_path):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (4, None, None), (9, "http://c/ x", ""), (7, "http://d/", "é" * 5000), (7, "http://d/", "é" * 5000), (None, "http://e/", "other"), (1, "http://f/", "unique \r\n\r\n WARC/1.1")]
    df = pages(spark, rows)
    path = f"file://{tmp_path}/a"
    manifest = warc.write_archive(df, path, roll_bytes=300).collect()
    assert sum(m.records for m in manifest) == len(rows) and not [x for x in os.listdir(tmp_path / "a") if x.endswith(".tmp")]
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for page, _, html in rows:
        payload = (html or "").encode()
        assert any(r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode() for r in by[page])
    assert by[5][0].record_type == "revisit" and by[5][0].refers_to == 3 and by[9][0].refers_to == 4 and by[3][0].record_type == "response" and by[3][0].payload == b"same"
    assert sorted(r.record_type for r in by[7]) == ["response", "revisit"]
    # A second run writes the same bytes to the same names.
    warc.write_archive(df.repartition(5), f"file://{tmp_path}/b", roll_bytes=300)
    files = sorted(x for x in os.listdir(tmp_path / "a") if x.startswith("part"))
    assert files == sorted(x for x in os.listdir(tmp_path / "b") if x.startswith("part")) and len(files) > 1
    assert all((tmp_path / "a" / x).read_bytes() == (tmp_path / "b" / x).read_bytes() for x in files)
    assert gzip.decompress((tmp_path / "a" / files[0]).read_bytes()).startswith(b"WARC/1.1\r\n")


def test_damage_is_found(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    file = warc.write_archive(pages(spark, [(1, "u", "x" * 100)]), path).first().file
    data = bytearray((tmp_path / "a" / file).read_bytes())
    data[-20] ^= 1
    (tmp_path / "a" / file).write_bytes(bytes(data))
    for crc in (tmp_path / "a").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="isn't as the manifest says"):
        warc.read_archive(spark, path).collect()


def test_empty_archive_and_least_size(spark, tmp_path):
    df = pages(spark, [(1, "u", "x"), (2, "u", "x")])
    warc.write_archive(df.limit(0), f"file://{tmp_path}/e")
    assert warc.read_archive(spark, f"file://{tmp_path}/e").count() == 0
    warc.write_archive(df, f"file://{tmp_path}/l", least=10)
    assert {r.record_type for r in warc.read_archive(spark, f"file://{tmp_path}/l").collect()} == {"response"}


def test_text_ids_and_shards_of_equal_bytes(spark, tmp_path, monkeypatch):
    """Shards depend on the pages only; ids may be text; null ids are spread."""
    monkeypatch.setattr(warc, "SHARD_BYTES", 4000)
    rows = [(f"p{i:03d}" if i % 3 else None, f"http://h/{i}", f"body {i % 40} " * 20) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    files = []
    for name, source in (("a", df), ("b", df.repartition(7))):
        warc.write_archive(source, f"file://{tmp_path}/{name}")
        files.append({x: (tmp_path / name / x).read_bytes() for x in os.listdir(tmp_path / name) if x.startswith("part")})
    assert files[0] == files[1] and len(files[0]) > 20
    got = warc.read_archive(spark, f"file://{tmp_path}/a", "string").collect()
    assert len(got) == 120 and sorted(r.page_id or "" for r in got) == sorted(r[0] or "" for r in rows)
    first = {}
    for page, _, html in rows:
        if page:
            first[html] = min(first.get(html, page), page)
    digest = {warc.digest(h.encode()): h for h in first}
    for r in got:
        own = first.get(digest.get(r.payload_digest))
        if own is not None:
            assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == own else ("revisit", own))


def test_any_text_is_an_id(spark, tmp_path):
    ids = ["", "x\r\ny: z", "tr\n", " a ", "%41", "é🙂", "WARC/1.1\r\n", None, "null"]
    rows = [(x, f"http://h/{k}", f"body {k // 2}") for k, x in enumerate(ids)]
    warc.write_archive(spark.createDataFrame(rows, "page_id string, url string, html string"), f"file://{tmp_path}/a")
    got = warc.read_archive(spark, f"file://{tmp_path}/a", "string").collect()
    assert sorted(map(repr, (r.page_id for r in got))) == sorted(map(repr, ids))
    for r in got:
        twins = [x for x, _, html in rows if warc.digest(html.encode()) == r.payload_digest and x is not None]
        assert r.refers_to == (min(twins) if r.record_type == "revisit" else None)


def test_pipeline_equals_plain_python(spark, tmp_path):
    """The whole chain on a small corpus: scores text by text, texts in a dictionary, all pairs of shingle sets, SQL for the
    sample, and token ids taken together again."""
    import corpus_pipeline
    from noisetrack.llm import toxicity
    from noisetrack.llm.common import read
    from noisetrack.llm.tokens import ByteTokens

    rnd = random.Random(4)
    docs = read(spark, SF, "documents")
    table = {r.doc_id: r.text or "" for r in docs.collect()}
    plain_id = max(table)
    more = []
    for k, (i, text) in enumerate(list(table.items())[:30]):  # copies and near copies
        words = text.split(" ")
        if len(words) > 60:
            words[rnd.randrange(len(words))] = "changed"
        more.append((plain_id + 1 + 2 * k, " ".join(words)))
        more.append((plain_id + 2 + 2 * k, text.upper() if text.isascii() else text))
    extra = spark.createDataFrame([(i, t, "en", "extra", len(t)) for i, t in more], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    read(spark, SF, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    docs, folder = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    table |= dict(more)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    model = toxicity.fit(docs, read(spark, SF, "labels"))
    left = {i: t for i, t in table.items() if toxicity.Scorer(model).score(t.encode()) < 0.5}
    steps = [f for _, f in corpus_pipeline.STAGES]
    got = steps[0](spark, docs, folder)
    assert ids(got) == set(left) < set(table)

    lower = {}
    for i, t in sorted(left.items()):
        lower["".join(c.lower() if "A" <= c <= "Z" else c for c in t)] = i  # the largest id stays
    left = {i: t for t, i in lower.items()}
    got = steps[1](spark, got, folder)
    assert ids(got) == set(left)

    def shingles(text):
        words = text.encode().split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}

    sets, root = {i: shingles(t) for i, t in left.items()}, {i: i for i in left}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(sets)
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    left = {i: t for i, t in left.items() if find(i) == i}
    got = steps[2](spark, got, folder)
    assert ids(got) == set(left) < set(sets)

    path = f"{tmp_path}/near.parquet"
    got.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({mixing.oracle()}) WHERE kept").fetchall()}
    got = steps[3](spark, spark.read.parquet(path), folder)
    assert ids(got) == kept < set(left)

    tokens, pieces, rooms = ByteTokens(), {}, {}
    for r in steps[4](spark, got, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        rooms.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.doc_tokens == len(tokens.encode(table[r.doc_id])) + 1
    assert set(pieces) == kept
    for parts, total in [(p, len(tokens.encode(table[i])) + 1) for i, p in pieces.items()] + [(p, None) for p in rooms.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total if total is not None else at <= 2048


def test_pipeline(spark):
    import corpus_pipeline
    from noisetrack.llm.common import read

    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after < before or (name == "toxicity" and after <= before), name
        before = after
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_of_odd_rows_and_empty_tables(spark, odd, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clashing = odd.withColumns({"_row": F.lit(1), "hash": F.lit("h"), "fp": F.lit("x"), "component_id": F.lit(3), "kept": F.lit(True)})
    for name, docs in (("odd", odd), ("empty", odd.limit(0)), ("clash", clashing)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() > 0 and corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, f"{tmp_path}/clash").columns == clashing.columns
    # Labels of none: nothing is toxic; null, empty and blank texts are one, as are equal and nearly equal texts.
    toxic, exact, near = (corpus_pipeline.STAGES[k][1] for k in range(3))
    after = exact(spark, toxic(spark, odd, f"{tmp_path}/odd"), f"{tmp_path}/odd")
    assert toxic(spark, odd, f"{tmp_path}/odd").count() == odd.count() and after.count() == 7
    assert sorted((r.doc_id is None, r.doc_id) for r in near(spark, after, f"{tmp_path}/odd").select("doc_id").collect() if r.doc_id is not None)[0] == (False, 2)
