"""Token files, packing and byte-level BPE beside the libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import byte_bpe, id_coder, packing, token_files, word_ids
from tidemark.llm.word_ids import WordIds

SCHEMA = "doc_id long, text string, start string, ids string"
ALPHABET = "aAbBéÉßÿŸµªºçÇ'`sStT 1²½.,!-_<>|ÀþÞ× ÷¡İıſǨ中文😀́\u0085\t\n\r\x1c<|endoftext|>"


def fuzz(n, length, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, length))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.default_vocabulary())
    found.encode_special_tokens = True
    return found


def expected_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate([None, "", "same words " * 4000, "same words " * 4000, *fuzz(60, 400)]))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, text, "x", None) for i, text in texts.items()]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_words_encode_as_whole_texts(tokenizer):
    words = WordIds(packing.default_vocabulary())
    for text in [*fuzz(3000, 40, 5), "<|endoftext|> a <|startoftext|>", "Don't WE'LL it's"]:
        assert np.array_equal(np.frombuffer(words.of(text), "<u2"), expected_ids(tokenizer, text))


def test_words_are_kept_once_and_within_bounds(tokenizer, monkeypatch):
    words = WordIds(packing.default_vocabulary())
    before = len(words)
    words.of("Alpha alpha ALPHA\nalpha, Alpha,")
    assert len(words) + len(words.older) - before == 3  # the word, the sign, and both together
    monkeypatch.setattr(word_ids, "KEEP", 40)
    for text in [*fuzz(300, 40, 7), "alpha, Beta's 中 Alpha", "alpha beta", "\u00a0 \x1f a\x0bb À×ß.", ""]:
        assert np.array_equal(np.frombuffer(words.of(text), "<u2"), expected_ids(tokenizer, text))
        assert len(words) + len(words.older) < 40 + 4 * 90  # and the words and pieces of two texts


@pytest.mark.parametrize("shape", [(1, 1), (3, 10), (40, 300), (5, 2048)])
@pytest.mark.parametrize("kind", ["random", "few", "constant", "extreme"])
def test_coder_round_trip(shape, kind):
    rng = np.random.default_rng(1)
    rows = {
        "random": lambda: rng.integers(0, 65536, shape),
        "few": lambda: rng.integers(0, 30, shape),
        "constant": lambda: np.full(shape, 7),
        "extreme": lambda: rng.choice([0, 65535], shape),
    }[kind]()
    codes = id_coder.encode(rows)
    assert np.array_equal(id_coder.decode(codes, shape[1]), rows)
    assert np.array_equal(id_coder.decode(codes[-1:], shape[1]), rows[-1:])  # blocks stand alone
    if kind == "few" and shape[1] > 2000:
        assert sum(map(len, codes)) < rows.size


def test_coding_a_group_takes_little_memory():
    ids = np.random.default_rng(4).integers(0, 300, token_files.GROUP_IDS).astype("<u2")
    tracemalloc.start()
    try:
        group = token_files.write_group([1], [ids.size], ids)
        ((_, _, back),) = token_files.read_groups(group + b"\n")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(back, ids)
    assert peak < 160 << 20


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.int64) % 700
    group = token_files.write_group([1, None], [4000, 1000], ids)
    (found,) = token_files.read_groups(group + b"\n")
    assert found[0] == [1, None] and np.array_equal(found[2], ids)
    for at in (30, len(group) - 40):
        damaged = group[:at] + bytes([group[at] ^ 1]) + group[at + 1 :]
        with pytest.raises(ValueError):
            list(token_files.read_groups(damaged + b"\n"))


def test_token_files(spark, docs, texts, tokenizer, tmp_path):
    token_files.write_token_files(docs, f"{tmp_path}/files")
    rows = {r.doc_id: r for r in token_files.read_token_files(spark, f"{tmp_path}/files").collect()}
    at = 0
    for doc_id, text in texts.items():
        ids = expected_ids(tokenizer, text)
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, ids.size, zlib.crc32(ids.tobytes()))
        at += ids.size


def test_repeated_and_missing_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a"), (3, "b"), (3, "b"), (3, "c d"), (None, None)], "doc_id long, text string")
    token_files.write_token_files(docs, f"{tmp_path}/files")
    rows = token_files.read_token_files(spark, f"{tmp_path}/files").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 3, 3, 3]
    assert packing.pack(docs).count() == 5 and byte_bpe.byte_bpe(docs).count() == 5


def test_packing(docs, texts, tokenizer):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, window=512).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids, at = expected_ids(tokenizer, texts[doc_id]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, ids.size)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == ids.size
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.geometric(0.002 * (seed + 1), 30_000), 4096)
    counts = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    used, windows = defaultdict(int), 0
    for times, combo in packing.make_plan(counts):
        assert sum(combo) <= 4096 and times > 0
        windows += times
        for n in combo:
            used[n] += times
    assert dict(used) == counts
    assert windows <= 1.01 * lengths.sum() / 4096 + 1


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    path, pattern = byte_bpe.default_ranks()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, encoding, monkeypatch):
    texts = [None, "", "a" * 100_000, " " * 70_000 + "x", "word " * 30_000, ("x" * 5000 + " ") * 20, "\n" * 33_000 + "y" * 40_000]
    texts += [*fuzz(200, 80), "".join(fuzz(400, 400, 9))]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    rows = byte_bpe.byte_bpe(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = np.array(encoding.encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (ids.size, hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty).collect() == [] and byte_bpe.byte_bpe(empty).collect() == []
    token_files.write_token_files(empty, f"{tmp_path}/none")
    assert token_files.read_token_files(spark, f"{tmp_path}/none").collect() == []
