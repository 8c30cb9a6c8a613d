"""Language-model scores from log-frequency Bloom filters that workers probe.

A filter holds quantised counts: a key of level q is a member under (key, 1) to (key, q), where level
q stands for counts from THRESHOLDS[q - 1] on. A count is read by probing levels until one is missing.
Two filters hold every word with its count and its number of distinct successors, and every pair of
words with its count, those seen once too. Both are cut into segments by key, whose number grows with
the tokens and whose size grows with their members: one task counts and writes a segment.

Filters of BROADCAST bytes or less, as measured after they are written, go to all workers, which probe
them for the texts they read; no text is shuffled. Larger ones stay in the shared folder: the distinct
keys of each chunk of texts are sent to the segments that own them, and levels come back. Both ways
probe the same bits, so scores do not depend on the way taken.

The score is absolute discounting: P(w | h) = max(c(h, w) - D, 0) / c(h) + D * t(h) / c(h) * P(w), with
t(h) the distinct successors of h, D = n1 / (n1 + 2 n2) from the exact numbers of pairs seen once and
twice, and P(w) = (c(w) + 1) / (N + V + 1), which leaves one share for unseen words. The probabilities
after a history sum to one but for the rounding of counts to levels and false members; where that
takes one above 1, it is 1.
"""

from __future__ import annotations

import functools
import math
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored

END = "\n"  # the end of a text: no word holds white space
SEGMENTS = 256  # of a filter, at least; a power of two
SEGMENT_KEYS = 1 << 20  # tokens for each segment, at most: its task holds no more keys
STEPS = 3  # levels for each doubling of a count
KEY_BITS = 12  # bits of the filter for each member, unless the caller wants fewer false members
BROADCAST = 128 << 20  # bytes of both filters up to which they are broadcast
HEAD = 150_000  # most frequent words, whose exact counts are broadcast
HEAD_BYTES = 64  # of such a word, at most; counts of longer ones are joined
CHUNK = 400_000  # words handled together
SUCCESSORS = 512  # added to the levels that stand for numbers of successors
FIRST_BITS = 40  # of a first word's key, beside a pair
KEPT_BITS = 40  # of a key, below those that name its segment: a segment holds far fewer keys than these tell apart

U = np.uint64
PACKED = struct.Struct("<BI")  # bytes of a number, numbers
#: The least count of each level: rounded up, steps of small counts fall together.
THRESHOLDS = np.unique(np.ceil(2 ** (np.arange(62 * STEPS) / STEPS) - 1e-6).astype(np.int64))


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; one without a doc_id is not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END.encode()]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> U(32)) * U(0xD6E8FEB86659FD93)
    h = (h ^ h >> U(29)) * U(0x9E3779B97F4A7C15)
    return h ^ h >> U(32)


def word_keys(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * U(3) + _mix(second))


def levels(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, np.maximum(counts, 1), side="right")


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; level 0: none."""
    low, high = THRESHOLDS[level - 1], THRESHOLDS[np.minimum(level, THRESHOLDS.size - 1)] - 1
    return np.where(level > 0, (low + np.maximum(low, high)) / 2, 0)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((keys >> U(32)) * U(segments) >> U(32)).astype(np.int64)


def _below(segments: int) -> int:
    """Bits of a key below those that name its segment."""
    return 65 - segments.bit_length()


def _dropped(segments: int) -> np.uint64:
    """Low bits of a key that are dropped."""
    return U(max(0, _below(segments) - KEPT_BITS))


def trimmed(keys: np.ndarray, segments: int) -> np.ndarray:
    return keys >> _dropped(segments) << _dropped(segments)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, where one of each is, the place of every key among them)

    np.unique() would sort stably, several times slower.
    """
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(keys.size, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(keys.size, np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


class Filter:
    """A Bloom filter in segments; a member sets six bits of one 64-bit word of its segment."""

    def __init__(self, segments: list[np.ndarray]):
        self.sizes = np.array([own.size for own in segments])
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(segments)

    @classmethod
    def of(cls, *members: tuple[np.ndarray, np.ndarray, int], key_bits: int = KEY_BITS) -> Filter:
        """One segment, as large as its members need: (keys, their levels, a number added to these)."""
        each = max(1, -(-sum(int(top.sum()) for _, top, _ in members) * key_bits // 64))
        bits = np.zeros(each, U)
        for keys, top, more in members:
            for level in range(1, int(top.max(initial=0)) + 1):
                at, own = cls.places(keys[top >= level], level + more, each)
                np.bitwise_or.at(bits, at, own)
        return cls([bits])

    @staticmethod
    def places(keys: np.ndarray, level: int, each: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Word of its segment and bits of each member."""
        h = _mix(keys ^ np.asarray(level, U) * U(0xA24BAED4963EE407))
        bits = U(1) << (h & U(63))
        for shift in (6, 12, 18, 24, 30):
            bits = bits | U(1) << (h >> U(shift) & U(63))
        return ((h >> U(36)) * np.asarray(each, U) >> U(28)).astype(np.int64), bits

    def levels(self, keys: np.ndarray, more: int = 0) -> np.ndarray:
        """The level of each key's count: probes go on for the keys that were members so far."""
        found = np.zeros(keys.size, np.int64)
        left, level = np.arange(keys.size), 1
        segment = segment_of(keys, self.sizes.size)
        begin, sizes = self.begin[segment], self.sizes[segment]
        while left.size and level < THRESHOLDS.size:
            at, bits = self.places(keys[left], level + more, sizes[left])
            left = left[self.words[begin[left] + at] & bits == bits]
            found[left] = level
            level += 1
        return found


def _coded(texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of every token, distinct tokens, number of tokens of each text)"""
    split = [tokens(text) for text in texts]
    every = [w for own in split for w in own]
    codes = {w: i for i, w in enumerate(dict.fromkeys(every))}
    return np.fromiter(map(codes.__getitem__, every), np.int64, len(every)), list(codes), np.array([len(s) for s in split])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Documents of a batch, some megabytes at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= 6 * CHUNK:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        for ids, texts in _chunks(batch):
            chosen = [text for doc_id, text in zip(ids, texts) if not held_out(doc_id)]
            if chosen:
                yield chosen


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode() for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts: Counter[bytes] = Counter()
    for texts in _training(batches):
        for text in texts:
            counts.update(tokens(text))
        if len(counts) > CHUNK:
            yield flush(counts)
            counts.clear()
    if counts:
        yield flush(counts)


def _batch(kinds: dict[str, pa.DataType], size: int, **columns) -> pa.RecordBatch:
    """Columns that are not given are null."""

    def column(name: str, kind: pa.DataType) -> pa.Array:
        own = columns.get(name)
        if own is None:
            return pa.nulls(size, kind)
        return own if isinstance(own, pa.Array) else pa.array(own, kind)

    return pa.RecordBatch.from_arrays([column(name, kind) for name, kind in kinds.items()], names=list(kinds))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, equal bytes side by side, compressed."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return PACKED.pack(width, x.size) + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, size = PACKED.unpack_from(data)
    planes = pa.Codec("zstd").decompress(data[PACKED.size :], width * size, asbytes=True)
    x = np.zeros((size, 8), np.uint8)
    x[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, size).T
    return x.view("<u8").ravel()


def _packed_in_order(x: np.ndarray) -> bytes:
    """Numbers in order, by the steps between them, which take fewer bytes."""
    return _packed(np.diff(x, prepend=U(0)))


def _unpacked_in_order(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=U)


class _Chunk:
    """Texts as places among their distinct words, whose keys are in order."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, codes: np.ndarray, segments: int):
        self.keys, self.sizes, self.codes = keys, sizes, codes
        self.starts = np.cumsum(sizes) - sizes
        inside = np.ones(codes.size, bool)
        inside[self.starts] = False  # a text's first word follows none
        self.second = np.flatnonzero(inside)
        self.first = codes[self.second - 1]
        self.segments = segments

    @classmethod
    def of(cls, codes: np.ndarray, distinct: list[bytes], sizes: np.ndarray, segments: int) -> _Chunk:
        keys = trimmed(word_keys(distinct), segments)
        order = np.argsort(keys)
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        return cls(keys[order], sizes, place[codes], segments)

    @functools.cached_property
    def paired(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pairs in order, where one of each is, the place of every pair among them)"""
        return _distinct(trimmed(pair_keys(self.keys[self.first], self.keys[self.codes[self.second]]), self.segments))

    def scores(self, word: np.ndarray, successors: np.ndarray, pair: np.ndarray, model: tuple[float, int]) -> np.ndarray:
        """Of each text, from the levels of its distinct words, of their successors, and of its pairs."""
        discount, total = model
        count = count_of(word)
        p = ((count + 1) / total)[self.codes]
        history = np.maximum(count, 1)
        # a training word has a successor, its text's end at least: one without any is a false member
        known = (word > 0) & (successors > 0)
        rest = np.where(known, np.minimum(discount * count_of(successors) / history, 1.0), 1.0)
        seen = np.maximum(count_of(pair)[self.paired[2]] - discount, 0)
        seen = np.where(known[self.first], seen / history[self.first], 0)
        p[self.second] = np.minimum(seen + rest[self.first] * p[self.second], 1.0)
        return np.add.reduceat(np.log10(p), self.starts)


_DEALT = "segment int, kind int, keys binary, counts binary, firsts binary"
_DEALT_KINDS = {"segment": pa.int32(), "kind": pa.int32()} | dict.fromkeys(["keys", "counts", "firsts"], pa.binary())
WORDS, TYPES, PAIRS = 0, 1, 2  # kinds of rows, and of levels


def _dealt(kind: int, segments: int, keys: np.ndarray, counts: np.ndarray, firsts: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted keys, one row for each segment that has any. The keys of TYPES are beginnings of keys."""
    whole = keys << U(64 - FIRST_BITS) if kind == TYPES else keys
    cuts = np.searchsorted(segment_of(whole, segments), np.arange(segments + 1))
    some = np.flatnonzero(np.diff(cuts))

    def cut(x: np.ndarray, pack: Callable = _packed) -> list[bytes]:
        return [pack(x[cuts[i] : cuts[i + 1]]) for i in some]

    short = keys if kind == TYPES else (keys & U((1 << _below(segments)) - 1)) >> _dropped(segments)
    columns = {"segment": some, "kind": np.full(some.size, kind), "keys": cut(short, _packed_in_order), "counts": cut(counts.astype(np.int64))}
    if firsts is not None:
        columns["firsts"] = cut(firsts)
    return _batch(_DEALT_KINDS, some.size, **columns)


def _keys(data: bytes, segment: int, segments: int) -> np.ndarray:
    """The keys that _dealt() packed for a segment."""
    return U(segment << _below(segments)) | _unpacked_in_order(data) << _dropped(segments)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, their summed counts, where each is first)"""
    distinct, index, place = _distinct(np.concatenate(keys))
    return distinct, np.bincount(place, np.concatenate(counts), distinct.size).astype(np.int64), index


def _deal_words(segments: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            own = pa.Table.from_batches(held)
            keys = trimmed(word_keys([w.encode() for w in own["word"].to_pylist()]), segments)
            order = np.argsort(keys)
            return _dealt(WORDS, segments, keys[order], own["c"].to_numpy()[order])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > CHUNK:
                yield flush()
                held = []
        if sum(b.num_rows for b in held):
            yield flush()

    return run


def _deal_pairs(segments: int) -> Callable:
    """The distinct pairs of training texts, summed over several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, firsts = [], [], []

        def flush() -> pa.RecordBatch:
            distinct, n, index = _merged(keys, counts)
            return _dealt(PAIRS, segments, distinct, n, np.concatenate(firsts)[index])

        for texts in _training(batches):
            chunk = _Chunk.of(*_coded(texts), segments)
            pairs, index, place = chunk.paired
            if not pairs.size:
                continue
            keys.append(pairs)
            counts.append(np.bincount(place))
            firsts.append(chunk.keys[chunk.first[index]] >> U(64 - FIRST_BITS))
            if sum(k.size for k in keys) > 8 * CHUNK:
                yield flush()
                keys, counts, firsts = [], [], []
        if keys:
            yield flush()

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each value of ``key``, by which the rows are sorted."""
    last, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != last and group:
                yield last, group
                group = []
            last = row[key]
            group.append(row)
    if group:
        yield last, group


_BUILT = _DEALT + ", bits binary, once long, twice long"
_BUILT_KINDS = _DEALT_KINDS | {"bits": pa.binary(), "once": pa.int64(), "twice": pa.int64()}


def _build_pairs(segments: int, key_bits: int) -> Callable:
    """Rows sorted by segment to the segment's bits, and to the successors it counts for first words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, rows in _groups(batches, "segment"):
            keys, counts, index = _merged(
                [_keys(r["keys"], segment, segments) for r in rows], [_unpacked(r["counts"]) for r in rows]
            )
            firsts, types = np.unique(np.concatenate([_unpacked(r["firsts"]) for r in rows])[index], return_counts=True)
            bits = Filter.of((keys, levels(counts), 0), key_bits=key_bits).words.tobytes()
            once, twice = int((counts == 1).sum()), int((counts == 2).sum())
            yield _batch(_BUILT_KINDS, 1, segment=[segment], kind=[PAIRS], bits=[bits], once=[once], twice=[twice])
            dealt = _dealt(TYPES, segments, firsts, types)
            yield _batch(_BUILT_KINDS, dealt.num_rows, **{name: dealt[name] for name in _DEALT_KINDS})

    return run


def _build_words(segments: int, key_bits: int) -> Callable:
    """Rows sorted by segment to the segment's bits: counts, and successors under levels of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, rows in _groups(batches, "segment"):
            parts = []
            for kind in (WORDS, TYPES):
                own = [r for r in rows if r["kind"] == kind]
                none = [np.zeros(0, U)]
                keys = (_unpacked_in_order(r["keys"]) if kind == TYPES else _keys(r["keys"], segment, segments) for r in own)
                parts.append(_merged([*none, *keys], [*none, *(_unpacked(r["counts"]) for r in own)]))
            (keys, counts, _), (firsts, types, _) = parts
            begin = keys >> U(64 - FIRST_BITS)
            at = np.searchsorted(firsts, begin)
            more = np.append(types, 0)[at] * (np.append(firsts, U(1) << U(63))[at] == begin)
            members = (keys, levels(counts), 0), (keys, levels(more) * (more > 0), SUCCESSORS)
            bits = Filter.of(*members, key_bits=key_bits).words.tobytes()
            yield _batch(_BUILT_KINDS, 1, segment=[segment], kind=[WORDS], bits=[bits])

    return run


def _by_segment(rows: DataFrame, *then: str) -> DataFrame:
    return rows.repartition("segment").sortWithinPartitions("segment", *then)


def _filter(rows: list, segments: int) -> Filter:
    own = {r["segment"]: np.frombuffer(r["bits"], U) for r in rows}
    return Filter([own.get(i, np.zeros(1, U)) for i in range(segments)])


_PREPARED = "row long, doc_id long, n_tokens long, known long, base double, score double, word string, times long"
_PREPARED += ", keys binary, sizes binary, codes binary"
_PREPARED_KINDS = dict.fromkeys(["row", "doc_id", "n_tokens", "known"], pa.int64())
_PREPARED_KINDS |= {"base": pa.float64(), "score": pa.float64(), "word": pa.string(), "times": pa.int64()}
_PREPARED_KINDS |= dict.fromkeys(["keys", "sizes", "codes"], pa.binary())


def _prepare(head_counts: Broadcast, filters: Broadcast | None, segments: int, model: tuple[float, int]) -> Callable:
    """A row for each document with the exact counts of head words, one for each other word of it, and,
    where no filters are broadcast to score the documents, one for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = head_counts.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for ids, texts in _chunks(batch):
                codes, distinct, sizes = _coded(texts)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                exact = np.array([head.get(w, -1) for w in distinct])[codes]
                known = np.add.reduceat((exact >= 0).astype(np.int64), starts)
                base = np.add.reduceat(np.where(exact >= 0, np.log10(np.maximum(exact, 0) + 1.0), 0), starts)
                tail = np.flatnonzero(exact < 0)
                document = np.searchsorted(ends, tail, side="right")
                both, times = np.unique(document * len(distinct) + codes[tail], return_counts=True)
                names = [distinct[i].decode() for i in (both % len(distinct)).tolist()]
                rows = row + np.arange(len(ids))
                own = {"row": rows, "doc_id": ids, "n_tokens": sizes, "known": known, "base": base}
                chunk = _Chunk.of(codes, distinct, sizes, segments)
                if filters:
                    words, pairs = filters.value
                    found = words.levels(chunk.keys), words.levels(chunk.keys, SUCCESSORS), pairs.levels(chunk.paired[0])
                    own["score"] = chunk.scores(*found, model)
                else:
                    coded = {name: [_packed(getattr(chunk, name))] for name in ("sizes", "codes")}
                    coded["keys"] = [_packed_in_order(chunk.keys >> _dropped(segments))]
                    yield _batch(_PREPARED_KINDS, 1, row=[row], **coded)
                yield _batch(_PREPARED_KINDS, len(ids), **own)
                yield _batch(_PREPARED_KINDS, both.size, row=rows[both // len(distinct)], word=names, times=times)
                row += len(ids)

    return run


_ASKED_KINDS = {"chunk": pa.int64(), "segment": pa.int32(), "kind": pa.int32(), "keys": pa.binary()}
_ASKED = "chunk long, segment int, kind int, keys binary"
_FOUND_KINDS = _ASKED_KINDS | {"levels": pa.binary()}
_FOUND = _ASKED + ", levels binary"


def _chunk(row: dict, segments: int) -> _Chunk:
    keys = _unpacked_in_order(row["keys"]) << _dropped(segments)
    return _Chunk(keys, *(_unpacked(row[name]).astype(np.int64) for name in ("sizes", "codes")), segments)


def _ask(segments: int) -> Callable:
    """The distinct words and pairs of each chunk, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _chunk(row, segments)
                for kind, keys in ((WORDS, chunk.keys), (PAIRS, chunk.paired[0])):
                    dealt = _dealt(kind, segments, keys, np.zeros(keys.size))
                    own = {name: dealt[name] for name in ("segment", "kind", "keys")}
                    yield _batch(_ASKED_KINDS, dealt.num_rows, chunk=[row["row"]] * dealt.num_rows, **own)

    return run


def _probe(segments: int) -> Callable:
    """Rows sorted by segment, its bits first, to the levels of the keys that were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, rows in _groups(batches, "segment"):
            own = {r["kind"]: Filter([np.frombuffer(r["bits"], U)]) for r in rows if r["chunk"] is None}
            chunks, kinds, back = [], [], []
            for base, wanted in ((WORDS, ((WORDS, 0), (TYPES, SUCCESSORS))), (PAIRS, ((PAIRS, 0),))):
                asked = [r for r in rows if r["chunk"] is not None and r["kind"] == base]
                if not asked:
                    continue
                keys = [_keys(r["keys"], segment, segments) for r in asked]
                cuts = np.cumsum([0, *(k.size for k in keys)])
                # what chunks share is probed once: the most frequent keys have the most levels
                distinct, _, place = _distinct(np.concatenate(keys))
                for kind, more in wanted:
                    found = own.get(base, Filter([np.zeros(1, U)])).levels(distinct, more)[place]
                    chunks += [r["chunk"] for r in asked]
                    kinds += [kind] * len(asked)
                    back += [_packed(found[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield _batch(_FOUND_KINDS, len(chunks), chunk=chunks, segment=[segment] * len(chunks), kind=kinds, levels=back)

    return run


def _score_chunks(segments: int, model: tuple[float, int]) -> Callable:
    """Each chunk, followed by its levels in the order of its keys, to the scores of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, own in _groups(batches, "row"):
            chunk = _chunk(own[0], segments)
            none = np.zeros(0, U)
            found = (np.concatenate([none, *(_unpacked(r["levels"]) for r in own if r["kind"] == kind)]) for kind in (WORDS, TYPES, PAIRS))
            score = chunk.scores(*(x.astype(np.int64) for x in found), model)
            yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(score.size)), pa.array(score)], names=["row", "score"])

    return run


def _scores_by_segment(coded: DataFrame, built: list[DataFrame], segments: int, model: tuple[float, int]) -> DataFrame:
    """(row, score) where filters are too large to be broadcast."""
    none = F.lit(None)
    asked = coded.mapInArrow(_ask(segments), _ASKED).withColumn("bits", none.cast("binary"))
    for own in built:
        asked = asked.union(own.select(none.cast("long"), "segment", "kind", none.cast("binary"), "bits"))
    found = stored(_by_segment(asked, F.col("chunk").asc_nulls_first()).mapInArrow(_probe(segments), _FOUND), "levels")
    rows = coded.select("row", "keys", "sizes", "codes", F.lit(-1).alias("kind"), F.lit(-1).alias("segment"), none.cast("binary").alias("levels"))
    rows = rows.union(found.select("chunk", *[none.cast("binary")] * 3, "kind", "segment", "levels"))
    by_chunk = rows.repartition("row").sortWithinPartitions("row", "kind", "segment")
    return by_chunk.mapInArrow(_score_chunks(segments, model), "row long, score double")


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = KEY_BITS) -> DataFrame:
    """One row per input row: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Counts are learnt from all rows that are not held out (held_out()). A null or empty text is its
    end alone; a very long one is scored whole, in the memory of one task. A row without doc_id
    trains; repeated rows count each time. Columns other than the two are ignored. Without any
    training row N and V are 0 and every count is 0. base_score uses exact counts: those of the most
    frequent words, fewer than HEAD and none longer than HEAD_BYTES, are broadcast, the others are
    joined by word.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = id_and_text(docs, id_col, text_col)
    counts = stored(
        rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "word_counts"
    )
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total = n_tokens + n_words + 1
    short = counts.filter(F.octet_length("word") <= HEAD_BYTES)
    bound = short.filter("c > 1").orderBy(F.desc("c")).limit(HEAD).agg(F.min("c")).first()[0] or 1
    head = {r["word"].encode(): r["c"] for r in short.filter(F.col("c") > bound).collect()}

    segments = max(SEGMENTS, 1 << (max(n_tokens - 1, 0) // SEGMENT_KEYS).bit_length())
    dealt = rows.mapInArrow(_deal_pairs(segments), _DEALT)
    pairs = stored(_by_segment(dealt).mapInArrow(_build_pairs(segments, key_bits), _BUILT), "pair_filter")
    types = pairs.filter(F.col("kind") == TYPES).select(*_DEALT_KINDS)
    words = counts.mapInArrow(_deal_words(segments), _DEALT).union(types)
    words = stored(_by_segment(words).mapInArrow(_build_words(segments, key_bits), _BUILT), "word_filter")
    built = [words, pairs.filter(F.col("kind") == PAIRS)]
    size, once, twice = built[0].union(built[1]).agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in (F.octet_length("bits"), "once", "twice")]).first()
    model = float(np.clip(once / max(once + 2 * twice, 1), 0.05, 0.95)), total

    filters = None
    if size <= BROADCAST:
        filters = spark.sparkContext.broadcast([_filter(own.select("segment", "bits").collect(), segments) for own in built])
    prepared = stored(rows.mapInArrow(_prepare(spark.sparkContext.broadcast(head), filters, segments, model), _PREPARED), "prepared")
    parts = prepared.filter("word is not null").join(counts, "word").select(
        "row", "times", (F.col("times") * F.log10(F.col("c") + 1.0)).alias("part"), F.lit(0.0).alias("more")
    )
    if not filters:
        coded = prepared.filter("keys is not null").select("row", "keys", "sizes", "codes")
        scores = stored(_scores_by_segment(coded, built, segments, model), "scores")
        parts = parts.union(scores.select("row", F.lit(0).cast("long"), F.lit(0.0), "score"))
    sums = parts.groupBy("row").agg(*[F.sum(name).alias(name) for name in ("times", "part", "more")])
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2

    def added(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return (
        prepared.filter("n_tokens is not null")
        .select("row", "doc_id", "n_tokens", "known", "base", "score")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            F.coalesce(out, F.lit(False)).alias("held_out"),
            "n_tokens",
            (F.col("known") + added("times")).alias("n_known"),
            F.lit(n_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + added("part") - F.col("n_tokens") * math.log10(total)).alias("base_score"),
            (added("score") + added("more")).alias("score"),
        )
    )


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
