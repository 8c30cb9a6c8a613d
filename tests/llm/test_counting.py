"""Collocations, token counts and the Merkle manifest beside brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import collocations, merkle, token_counts

# --- collocations --------------------------------------------------------------------------------


def all_phrases(rows, least, top, depth=5):
    """Every phrase counted in plain dictionaries; rows: (lang, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, min(depth, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {
            q[i:j]
            for q, b in phrases.items()
            for i in range(len(q))
            for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and b >= phrases[q[i:j]]
        }
        ranked = []
        for p, a in phrases.items():
            if p not in inner:
                cut = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cut)
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for place, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, place, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(3)
    words, gaps = ["a", "B", "b", "é", "x" * 3000, "中"], [" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b"]
    rows = []
    for _ in range(200):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([None, "und", "en", "de"]), rng.choice([None, "", text, text])))
    rows += [("en", "is onhe " * 3000)] * 3 + [("fr", "one word only")]
    return rows


@pytest.fixture(scope="module")
def speech_table(spark, speech):
    return spark.createDataFrame([(lang, text, 1, "x") for lang, text in speech], "lang string, text string, phrase int, word string").repartition(6)


@pytest.mark.parametrize("hot, least, top", [(1 << 16, 5, 50), (20, 5, 3), (0, 2, 1000)])
def test_collocations_equal_plain_counts(speech_table, speech, monkeypatch, hot, least, top):
    """With few words, and all, being hot, in many groups and chunks."""
    monkeypatch.setattr(collocations, "HOT", hot)
    monkeypatch.setattr(collocations, "HOT_SHARE", 1 << 40)
    monkeypatch.setattr(collocations, "GROUP", 50)
    found = collocations.collocations(speech_table, least=least, top=top)
    assert sorted(map(tuple, found.collect())) == all_phrases(speech, least, top)


def test_collocations_of_nothing(spark, speech_table):
    assert collocations.collocations(speech_table.limit(0)).collect() == []
    assert collocations.collocations(speech_table.limit(1), least=10**6).collect() == []


def test_prefixes_are_found_whatever_the_order():
    rng = np.random.default_rng(1)
    for trial in range(30):
        windows = rng.integers(0, rng.integers(2, 30), (int(rng.integers(1, 400)), 4)).astype(np.uint64)
        windows[:, 0] += np.uint64(1)
        for j in range(1, 4):
            windows[windows[:, j - 1] == 0, j] = 0
        counts = rng.integers(1, 5, len(windows)).astype(np.uint32)
        expected = Counter()
        for window, n in zip(windows.tolist(), counts.tolist()):
            for size in range(1, 5):
                if window[size - 1]:
                    expected[tuple(window[:size])] += n
        found = collocations.frequent_prefixes(windows, counts, np.ones(len(windows), np.uint8), 10, 2)
        got = {tuple(windows[r, :size].tolist()): n for rows, size, number in found for r, n in zip(rows.tolist(), number.tolist())}
        assert got == {p: n for p, n in expected.items() if n >= 10 and len(p) > 1}


def test_products_beyond_64_bits_are_exact(spark):
    words = spark.createDataFrame(
        [(b"a" * 8, "en", "a", 9_000_000_000_000), (b"b" * 8, "en", "b", 7_000_000_000_001)], "phrase binary, lang string, word string, n long"
    )
    phrases = spark.createDataFrame([(b"a" * 8 + b"b" * 8, 2, 0, 6_999_999_999_999)], "phrase binary, size int, hash long, n long")
    n, a, left, right = 16_000_000_000_001, 6_999_999_999_999, 9_000_000_000_000, 7_000_000_000_001
    assert collocations._scored(phrases, words).first()["score"] == 1000 * a * n // (left * right)


# --- token counts --------------------------------------------------------------------------------

TEXTS = [
    None, "", " ", "a", "  a  b ", "\n", "a\n\nb", "▁x ▁", "m².com ²", "<s> </s><unk> <0x0A>", "don't_stop -- it's", "\x00\t　ﬁ é",
    "中文 😀", "x" * 30_000, "same words " * 5000, "same words " * 5000,
]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.PieceCounts(token_counts.default_model())


def test_pre_tokens_have_the_pieces_of_the_text(pieces):
    rng = random.Random(1)
    letters = "aB ▁\n\t².,'é中1_\x00 　ﬁ<s>"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert sum(map(pieces.count, pieces.pre_tokens(text))) == len(pieces.library.encode(text)), text


@pytest.mark.parametrize("head", [0, 3, token_counts.HEAD])
def test_token_counts_equal_the_library(spark, pieces, head):
    rows = [(i if i % 3 else None, text, "r") for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(4)
    found = token_counts.token_counts(docs, head=head)
    expected = []
    for doc_id, text, _ in rows:
        n = len(pieces.library.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- Merkle manifest -----------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def whole_manifest(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        by_source[source].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append(tree([leaf(r, r["text"]) for r in by_source[source]]))
    top = tree([t[-1][0] for t in trees])
    found = []
    for s, source in enumerate(sources):
        for i, row in enumerate(by_source[source]):
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest, proof = leaf(row, text), []
            for levels, at in ((trees[s], i), (top, s)):
                for nodes in levels[:-1]:
                    run, k = nodes[at - at % 3 : at - at % 3 + 3], at % 3
                    proof += run[:k] + run[k + 1 :]
                    run[k] = digest
                    digest, at = sha(*run), at // 3
            found.append((row["doc_id"], leaf(row, row["text"]), trees[s][-1][0], top[-1][0], sha(*proof), digest, digest == top[-1][0]))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def records():
    rng = random.Random(2)
    sources = [None, "", "a", "b", "é", "zz", *["hot"] * 9, *[f"s{k}" for k in range(9)]]
    rows = [
        {
            "doc_id": rng.choice([None, *range(80)]), "source": rng.choice(sources), "lang": rng.choice([None, "en"]),
            "n_chars": rng.choice([None, 3]), "text": rng.choice([None, "", "x\ny", "a", "long line\n" * 20_000]),
        }
        for _ in range(250)
    ]
    return rows + rows[:20]


@pytest.mark.parametrize("local", [0, 2, merkle.LOCAL])
def test_manifest_equals_whole_trees(spark, records, local):
    rows = [(*r.values(), "clash", 7) for r in records]
    schema = "doc_id long, source string, lang string, n_chars long, text string, leaf string, s int"
    docs = spark.createDataFrame(rows, schema).repartition(5)
    found = merkle.merkle_manifest(docs, merkle.without_line_ends(docs), local=local)
    assert sorted(map(tuple, found.collect()), key=str) == whole_manifest(records)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10])
def test_manifest_of_few_rows(spark, n):
    rows = [{"doc_id": i, "source": "s", "lang": "en", "n_chars": 1, "text": "t\n"} for i in range(n)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.merkle_manifest(docs, merkle.without_line_ends(docs), local=1)
    assert sorted(map(tuple, found.collect()), key=str) == (whole_manifest(rows) if rows else [])


def test_manifest_without_tampering_is_verified(spark, records):
    docs = spark.createDataFrame([tuple(r.values()) for r in records], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.merkle_manifest(docs).filter("NOT verified").isEmpty()
