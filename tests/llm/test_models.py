"""Toxicity and language-model scores: exact parts beside brute force, the rest by held-out quality."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, lm_scoring, toxicity

SCHEMA = "doc_id long, text string, word string, score string"


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def prose(rng, n, words):
    return " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=n))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(4)
    return ["".join(rng.choice("aeioulmnrstéß") for _ in range(rng.randrange(2, 9))) for _ in range(600)]


def test_lm_scores(spark, words, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD", 40)
    rng = random.Random(1)
    texts = [None, "", "Word wOrD\x0bword\x1cword", "never seen before 😀", *(prose(rng, 60, words) for _ in range(300))]
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in enumerate(texts)], SCHEMA)
    split = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")), None] for i, t in enumerate(texts)}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in split}
    counts = Counter(w for i, own in split.items() if not out[i] for w in own)
    total, distinct = sum(counts.values()), len(counts)
    rows = lm_scoring.lm_scores(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = split[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(own), sum(w in counts for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_pairs_help_where_text_is_predictable(spark, words):
    rng = random.Random(6)
    phrases = [prose(rng, 6, words) for _ in range(40)]
    texts = [" ".join(rng.choices(phrases, k=15)) for _ in range(300)]
    rows = lm_scoring.lm_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_filter_never_reads_too_low_a_level():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    top = lm_scoring.levels(rng.geometric(0.01, keys.size))
    more = lm_scoring.levels(rng.geometric(0.1, keys.size))
    segment = lm_scoring.segment_of(keys, 16)
    parts = [lm_scoring.Filter.of((keys[segment == i], top[segment == i], 0), (keys[segment == i], more[segment == i], 512)).words for i in range(16)]
    whole = lm_scoring.Filter(parts)
    strangers = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2)
    for own, added in ((top, 0), (more, 512)):
        found = whole.levels(keys, added)
        assert (found >= own).all() and (found == own).mean() > 0.9
        assert (whole.levels(strangers, added) == 0).mean() > 0.9


def test_scores_are_absolute_discounting(spark, words):
    """Brute force with exact counts, rounded to levels, beside filters so wide that few false members are left."""
    rng = random.Random(21)
    texts = [None, "", "a", "never seen before", *(prose(rng, 30, words) for _ in range(200)), "a b " * 30_000]
    split = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")), None] for t in texts]
    train = [own for i, own in enumerate(split) if not lm_scoring.held_out(i)]
    single = Counter(w for own in train for w in own)
    pairs = Counter(p for own in train for p in zip(own, own[1:]))
    successors = Counter(first for first, _ in pairs)
    once, twice = (sum(n == k for n in pairs.values()) for k in (1, 2))
    discount = min(max(once / (once + 2 * twice), 0.05), 0.95)
    total = sum(single.values()) + len(single) + 1

    def level(n):
        return float(lm_scoring.count_of(lm_scoring.levels(np.array([n])))[0]) if n else 0.0

    close = []
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm_scoring.lm_scores(docs, key_bits=128).collect()
    for r in rows:
        own = split[r.doc_id]
        expected = math.log10((level(single[own[0]]) + 1) / total)
        for first, second in zip(own, own[1:]):
            p, c = (level(single[second]) + 1) / total, level(single[first])
            if c:
                p = max(level(pairs[first, second]) - discount, 0) / c + min(discount * level(successors[first]) / c, 1) * p
            expected += math.log10(min(p, 1.0))
        close.append(math.isclose(r.score, expected, rel_tol=1e-9))
        assert r.score == pytest.approx(expected, rel=0.05)
    assert len(rows) == len(texts) and sum(close) > 0.95 * len(rows)


def test_scores_are_finite_where_unseen_words_are_false_members(spark, words):
    """With filters this narrow many unseen words read as seen, without any successor."""
    rng = random.Random(31)
    texts = {i: prose(rng, 40, words) for i in range(300)}
    for i in texts:
        if lm_scoring.held_out(i):
            texts[i] = " ".join(f"unseen{rng.randrange(10**6)}" for _ in range(40))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = lm_scoring.lm_scores(docs, key_bits=6).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and all(r.score > r.base_score - 0.2 * r.n_tokens for r in held)


def test_broadcast_filters_and_segments_in_place_give_the_same_scores(spark, words, monkeypatch):
    rng = random.Random(22)
    texts = [None, "", "only once", *(prose(rng, 40, words) for _ in range(150)), "x y z " * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    ways = []
    for limit in (lm_scoring.BROADCAST, 0):
        monkeypatch.setattr(lm_scoring, "BROADCAST", limit)
        ways.append(sorted(map(tuple, lm_scoring.lm_scores(docs).collect())))
    assert len(ways[0]) == len(texts)
    for one, two in zip(*ways):
        assert one[:5] == two[:5] and one[5:] == pytest.approx(two[5:], rel=1e-9)


@pytest.mark.parametrize("segments", [256, 1 << 20, 1 << 26])
def test_keys_survive_the_way_to_their_segment(segments):
    keys = np.sort(np.random.default_rng(5).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    keys = lm_scoring.trimmed(keys, segments)
    batch = lm_scoring._dealt(lm_scoring.WORDS, segments, keys, np.ones(500))
    back = [lm_scoring._keys(r["keys"], r["segment"], segments) for r in batch.to_pylist()]
    assert (np.concatenate(back) == keys).all()


def test_numbers_survive_packing():
    rng = np.random.default_rng(9)
    for x in (np.zeros(0, np.uint64), np.zeros(7, np.uint64), rng.integers(0, 2**63, 900).astype(np.uint64) * np.uint64(2)):
        assert (lm_scoring._unpacked(lm_scoring._packed(x)) == x).all()
        assert (lm_scoring._unpacked_in_order(lm_scoring._packed_in_order(np.sort(x))) == np.sort(x)).all()
    keys = np.sort(rng.integers(0, 2**40, 12_000).astype(np.uint64))
    assert len(lm_scoring._packed_in_order(keys)) < 0.8 * 5 * keys.size


def test_keys_that_chunks_share_are_probed_once(monkeypatch):
    keys = lm_scoring.trimmed(np.sort(np.random.default_rng(3).integers(0, 2**62, 500).astype(np.uint64)), 1)
    own = lm_scoring.Filter.of((keys, np.arange(keys.size) % 9 + 1, 0))
    rows = [{"chunk": None, "segment": 0, "kind": lm_scoring.WORDS, "keys": None, "bits": own.words.tobytes()}]
    for chunk in range(4):
        (dealt,) = lm_scoring._dealt(lm_scoring.WORDS, 1, keys, np.zeros(keys.size)).to_pylist()
        rows.append({"chunk": chunk, "segment": 0, "kind": lm_scoring.WORDS, "keys": dealt["keys"], "bits": None})
    kinds = {"chunk": pa.int64(), "segment": pa.int32(), "kind": pa.int32(), "keys": pa.binary(), "bits": pa.binary()}
    asked, plain = [], lm_scoring.Filter.levels

    def levels(self, keys, more=0):
        asked.append(keys.size)
        return plain(self, keys, more)

    monkeypatch.setattr(lm_scoring.Filter, "levels", levels)
    (found,) = lm_scoring._probe(1)(iter([pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))]))
    assert asked == [keys.size, keys.size]  # words, and their successors
    back = [lm_scoring._unpacked(r["levels"]) for r in found.to_pylist() if r["kind"] == lm_scoring.WORDS]
    assert len(back) == 4 and all((x == plain(own, keys)).all() for x in back)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for i in range(blocks.size()) if "shuffle_" in (f := blocks.apply(i).getName())}

    before, setting = files(), spark.conf.get(common.CLEANUP, None)
    rows = common.stored(spark.range(5000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count(), "no_files")
    assert spark.conf.get(common.CLEANUP, None) == setting
    for _ in range(100):  # executors remove them in their own time
        if not (left := {f for f in files() - before if f.endswith(".data")}):
            break
        time.sleep(0.1)
    assert not left and len(rows.collect()) == 10


def test_long_words_are_not_collected(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD_BYTES", 3)
    docs = spark.createDataFrame([(i, "abc abcdefgh abc longerword") for i in range(40)], "doc_id long, text string")
    for r in lm_scoring.lm_scores(docs).collect():
        assert r.n_known == r.n_tokens == 5


def test_lm_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a a"), (None, "a a"), (2, None)], "doc_id long, text string")
    rows = lm_scoring.lm_scores(docs).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 3, 3]
    assert lm_scoring.lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_word_filter_grows_with_its_members(spark):
    rng = np.random.default_rng(2)
    sizes = []
    for n in (2_000, 200_000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        own = lm_scoring.Filter.of((keys, lm_scoring.levels(rng.geometric(0.3, n)), 0))
        strangers = rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        assert (own.levels(strangers) == 0).mean() > 0.9
        sizes.append(own.words.size)
    assert sizes[1] > 90 * sizes[0]


def test_unseen_words_score_low_and_segments_do_not_matter(spark, words, monkeypatch):
    rng = random.Random(8)
    held = [i for i in range(400) if lm_scoring.held_out(i)][:2]
    texts = {i: prose(rng, 60, words) for i in range(400)}
    texts[held[0]], texts[held[1]] = "unseen1 unseen2 unseen3", " ".join(words[:3])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    totals = []
    for tokens_each in (1 << 20, 16):
        monkeypatch.setattr(lm_scoring, "SEGMENT_KEYS", tokens_each)
        score = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs).collect()}
        assert len(score) == 400 and score[held[1]] > score[held[0]] + 3
        totals.append(sum(score.values()))
    assert totals[0] == pytest.approx(totals[1], rel=0.01)


def test_pairs_seen_once_are_held(spark, words):
    rng = random.Random(12)
    held, train = [next(i for i in range(99) if lm_scoring.held_out(i) == side) for side in (True, False)]
    others = {i: prose(rng, 60, words) for i in range(100, 400)}
    scores = []
    for order in (["zza", "zzb", "zzc", "zzd", "zze"], ["zzb", "zze", "zza", "zzd", "zzc"]):
        texts = {held: "zza zzb zzc zzd zze", train: " ".join(order)} | others
        rows = lm_scoring.lm_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
        scores.append(next(r.score for r in rows if r.doc_id == held))
    assert scores[0] > scores[1] + 3  # the same words; pairs that were seen once, or never


INSULTS = ["idiot", "moron", "stupid"]


@pytest.fixture(scope="module")
def labelled(spark, words):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(900):
        own = prose(rng, 40, words).split()
        toxic = rng.random() < 0.2
        if toxic:
            own[rng.randrange(40)] = rng.choice(INSULTS)
        texts.append(" ".join(own))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity(spark, labelled):
    texts, labels = labelled
    rng = random.Random(3)
    disguised = ["1d10t", "i.d.i.o.t", "m o r o n", "stuuuupid", "m0r0n", "s-t-u-p-i-d", "ST*PID"]
    more = [f"{texts[rng.randrange(50)].split()[0]} la {d} na mo" for d in disguised] + [None, "", "la na mo", "v1.2 a4 b52 100"]
    docs = spark.createDataFrame([(i, t, "w", "s") for i, t in enumerate([*texts, *more])], SCHEMA)
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    assert len(rows) == len(texts) + len(more)
    for i, toxic in labels:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert rows[i].predicted == toxic and rows[i].predicted == int(rows[i].score >= 0.3)
    for k, text in enumerate(more):
        assert rows[len(texts) + k].predicted == int(k < len(disguised)), text


def test_disguised_words_beside_single_letters_and_in_long_runs(spark, labelled):
    texts, labels = labelled
    disguised = [
        "you are a m o r o n", "a s t u p i d", "y o u i d i o t", "l.a-m.o.r.o.n", "la_lo-me.ri_so-ta.ne_1d10t.lo_me-ta",
        "l a m e l o r i s o t a n e r u l i m o s t u p i d l a", "m" + "0" * 40 + "r0n", "lo_" * 20 + "1d10t",
    ]
    clean = ["l a m e l o r i s o t a n e r u l i", "a b c d e f g h", "la_lo-me.ri_so-ta.ne_1.lo_me-ta", "x1" * 200_000]
    docs = spark.createDataFrame([*enumerate(texts), *((1000 + i, f"la {d} na") for i, d in enumerate(disguised + clean))], "doc_id long, text string")
    rows = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert {d: rows[1000 + i] for i, d in enumerate(disguised + clean)} == {**dict.fromkeys(disguised, 1), **dict.fromkeys(clean, 0)}


@pytest.mark.parametrize("word", ["1d10t", "m.0.r", "a-b c", "st*p1d", "aaab!!", "|_|7", "l...l", "é1é", "s t u", "****"])
def test_decoding_finds_the_best_of_all_readings(word):
    for seed in range(5):
        rng = np.random.default_rng(seed)
        decoder = toxicity.Decoder(rng.geometric(0.02, toxicity._LETTERS**3) * (rng.random(toxicity._LETTERS**3) < 0.3))
        readings = Counter()
        for path in itertools.product(*decoder.lattice(word)):
            text = "".join(chars for chars, _ in path)
            a, b, p = 0, 0, sum(cost for _, cost in path)
            for c in text:
                code = toxicity._ORDER.get(c, 27)
                p += decoder.log[a][b][code]
                a, b = (b, code) if code else (0, 0)
            p += decoder.log[a][b][0]
            readings[text] = max(readings.get(text, -math.inf), p)
        best = max(readings.values())
        assert readings[decoder.decode(word)] == pytest.approx(best, abs=1e-9)


def test_features_of_very_long_words_are_their_beginnings():
    assert toxicity.features("moron") == ["moron", "moro~"]
    assert toxicity.features("x" * 50) == ["xxxx~", "xxxxx~", "xxxxxx~"]


def test_held_out_labels_teach_nothing(spark, labelled):
    texts, labels = labelled
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wrong = [(i, 1 - t if toxicity.held_out(i) else t) for i, t in labels]
    scores = [
        sorted(map(tuple, toxicity.toxicity(docs, spark.createDataFrame(own, "doc_id long, toxic int")).collect()))
        for own in (labels, wrong)
    ]
    assert scores[0] == scores[1]


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.toxicity(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), none).collect() == []
