"""SimHash links, suffix dedup and the pipeline beside brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidemark.llm import components, exact_dedup, quality_rules, simhash, suffix_dedup

SCHEMA = "doc_id long, text string, fp string, gram string"


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable over links of at most two bits."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(n, seed=2):
    rng = random.Random(seed)
    base = [rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(400)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, 12)):
            own[rng.randrange(400)] = str(rng.random())
        yield " ".join(own)


@pytest.mark.parametrize("crowd", [128, 8])
def test_simhash(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    texts = [*near_copies(250), None, "", " ", "Hi", "hi", "two words", "l" * 50_000, "x " * 9000]
    docs = spark.createDataFrame([(7 * i, t, "a", "b") for i, t in enumerate(texts)], SCHEMA)
    prints = {7 * i: brute_fingerprint(t) for i, t in enumerate(texts)}
    expected = brute_components(prints)
    rows = simhash.simhash(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", expected[r.doc_id])
    kept = simhash.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_simhash_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (5, "a b c"), (9, "x y")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.simhash(docs).collect()} == {(None, 5), (5, 5), (9, 9)}
    assert simhash.drop_near(docs).count() == 4


def test_allocation_is_cheapest():
    rng = np.random.default_rng(3)
    for _ in range(20):
        cost = [[0.0, *rng.integers(1, 100, 3).tolist()] for _ in range(3)]
        options = [
            (cost[0][a + 1] + cost[1][b + 1] + cost[2][c + 1])
            for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0
        ]
        best, radii = simhash.allocate(cost, 0)
        assert best == min(options) and sum(radii) == 0


def test_components_of_a_long_path(spark):
    nodes = list(range(60))
    random.Random(1).shuffle(nodes)
    edges = list(zip(nodes, nodes[1:])) + [(100, 101), (101, 100), (200, 200)]
    found = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{n: 0 for n in nodes}, 100: 100, 101: 100}


def brute_repeats(texts, length):
    seen = Counter(t[p : p + length] for t in texts.values() for p in range(len(t) - length + 1))
    result = {}
    for doc_id, t in texts.items():
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        result[doc_id] = (len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return result


def passages(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(800)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    shared = [prose(100) for _ in range(4)]
    for _ in range(150):
        parts = [prose(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(shared)
            parts += [passage[rng.randrange(150) : len(passage) - rng.randrange(100)], prose(rng.randrange(60))]
        yield " ".join(parts)


@pytest.mark.parametrize("crowd, chunk", [(2000, 1 << 20), (10, 5000)])
def test_suffix_dedup(spark, monkeypatch, crowd, chunk):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    texts = [*passages()]
    texts += [texts[3], texts[3], None, "", "a" * 3000, "ab" * 900, "é" * 700, "x" * 399, "\0" * 500 + "q", "\0" * 450]
    docs = spark.createDataFrame([(i, t, "f", "g") for i, t in enumerate(texts)], SCHEMA)
    expected = brute_repeats({i: (t or "").encode() for i, t in enumerate(texts)}, 400)
    rows = suffix_dedup.suffix_dedup(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected
    both = suffix_dedup.suffix_dedup(docs, shorter=90).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in both} == expected
    shorter = brute_repeats({i: (t or "").encode() for i, t in enumerate(texts)}, 90)
    assert {r.doc_id: r.n_repeated for r in both} == {doc_id: own[1] for doc_id, own in shorter.items()}
    kept = suffix_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns
    for r in kept.collect():
        own = expected[r.doc_id]
        if own[1] == 0:
            assert r.text == texts[r.doc_id]
        elif (texts[r.doc_id] or "").isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == own[3]


def test_repeated_rows_go_whole(spark):
    docs = spark.createDataFrame([(None, "z" * 100 + "y" * 500), (None, "z" * 100 + "y" * 500)], "doc_id long, text string")
    assert [(r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_dedup(docs).collect()] == [(600, 600)] * 2


@pytest.mark.parametrize("operator", [simhash.simhash, simhash.drop_near, suffix_dedup.suffix_dedup, suffix_dedup.drop_repeats])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    """Every stage against the plain meaning of its operator, on documents with copies and junk."""
    rng = random.Random(11)
    words = ["the", "of", "and", *("".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(500))]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    texts = [prose(120) for _ in range(30)]
    shared = prose(90)
    texts += [texts[0], texts[0], texts[1] + " end", "too short", None, "# " * 80]
    texts += [prose(40) + " " + shared + " " + prose(40) for _ in range(5)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    docs = spark.read.parquet(path)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = seen[name][1]

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    before, after = seen["quality_rules"]
    assert ids(after) == {r.doc_id for r in quality_rules.quality_rules(before).filter("kept").collect()}
    assert not ids(after) & {33, 34, 35}
    before, after = seen["exact_dedup"]
    assert ids(after) == {r.doc_id for r in exact_dedup.exact_dedup(before).filter("kept").collect()}
    assert 31 in ids(after) and not ids(after) & {0, 30}
    before, after = seen["simhash_near_dedup"]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in before.collect()}
    assert ids(after) == set(brute_components(prints).values())
    before, after = seen["suffix_array_dedup"]
    assert after.columns == before.columns and ids(after) == ids(before)
    expected = brute_repeats({r.doc_id: r.text.encode() for r in before.collect()}, 400)
    for r in after.collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == expected[r.doc_id][3] and r.n_chars == len(r.text)
    before, after = seen["packing"]
    lengths = defaultdict(int)
    for r in after.collect():
        lengths[r.doc_id] += r.length
    assert set(lengths) == ids(before)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == after.count()


def test_repeats_shorter_than_an_anchor_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(docs, length=suffix_dedup.GRAM - 1)
