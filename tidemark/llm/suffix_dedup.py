"""Removal of repeated long byte strings by bounded interval expansion over sampled suffixes.

A window is a string of ``length`` bytes inside one document. Its anchor is the smallest gram (GRAM
bytes, by hash, the leftmost of equals) in it, so equal windows have equal anchors at equal
offsets, and only suffixes that begin at anchors have to be sorted: one in some 170 bytes.

1. Every document lists its anchors with the span, the union of the windows that have this anchor.
   Spans found twice are repeated as a whole. A gram found once ends here.
2. Where different spans share a gram, the rows of the gram are put in the order of their suffixes
   with the common prefixes of neighbours: the empty interval. Backward extension then splits every
   interval by the byte before, stably, as a Burrows-Wheeler transform does, breadth first, so the
   order stays that of the suffixes. At level t a row's longest common prefix with its neighbours is
   t bytes longer than that of its suffix; from ``length`` on its window at offset t is repeated.
   Intervals of one row, and rows that cannot reach ``length`` any more, are dropped.
3. A gram with more than CROWD spans is split over tasks first: by halves of the offsets, the bytes
   that all windows of a half share being the new gram, until groups are small or a half is one
   window, which equal grams decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ship, stored

LENGTH = 400  # bytes
SHORTER = 250  # bytes of repeated strings that are reported too: 50 words of four letters and a space
GRAM = 64  # bytes of an anchor
CROWD = 2000  # spans of a gram that one task sorts
CHUNK = 1 << 20  # bytes hashed together, and rows x 50 sorted together

U = np.uint64


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position of ``x`` on; shorter by GRAM - 1."""
    h = x.astype(U)
    size = 1
    while size < 8:
        h = h[:-size] | h[size:] << U(8 * size)
        size *= 2
    while size < GRAM:
        h = h[:-size] * U(0x9E3779B97F4A7C15) + (h[size:] ^ h[size:] >> U(31)) * U(0xC2B2AE3D27D4EB4F)
        h ^= h >> U(29)
        size *= 2
    h *= U(0xFF51AFD7ED558CCD)
    return h ^ h >> U(32)


def find_anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, gram, anchor, first window, last window) of documents that lie end to end."""
    starts = np.concatenate([[0], ends[:-1]])
    none = (np.zeros(0, np.int64),) * 5
    count = np.maximum(ends - starts - length + 1, 0)  # windows of each document
    if not count.sum():
        return none
    grams = _gram_hashes(data)
    # upper half: hash; lower half: place, so that the leftmost of equals is the smallest
    least = (grams & U(0xFFFFFFFF00000000)) | np.arange(grams.size, dtype=U)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: least.size - (width - size)], least[width - size :])
    document = np.repeat(np.arange(ends.size), count)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    window = first + np.arange(count.sum())
    anchor = (least[window] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])]))
    last = np.append(new[1:], window.size) - 1
    at = anchor[new]
    return document[new], grams[at].view(np.int64), at, window[new], window[last]


_ANCHORS = "k1 long, k2 long, gram long, span long, start int, lo int, hi int"


def _anchors(length: int) -> Callable:
    if length < GRAM:
        raise ValueError(f"repeated strings of {length} bytes hold no anchor of {GRAM} bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = batch["text"].to_pylist()
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
                    size += len(texts[j])
                    j += 1
                joined = b"".join(texts[i:j])
                ends = np.cumsum([len(t) for t in texts[i:j]])
                if len(joined) >= length:
                    data = np.frombuffer(joined, np.uint8)
                    document, gram, at, first, last = find_anchors(data, ends, length)
                    begin = np.concatenate([[0], ends[:-1]])[document]
                    spans = [digest(joined[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(k1[i + document]), pa.array(k2[i + document]), pa.array(gram),
                            pa.array(np.array(spans, U).view(np.int64)), pa.array((first - begin).astype(np.int32)),
                            pa.array((at - first).astype(np.int32)), pa.array((at - last).astype(np.int32)),
                        ],
                        names=["k1", "k2", "gram", "span", "start", "lo", "hi"],
                    )
                i = j

    return run


def repeated_windows(groups: np.ndarray, texts: list[bytes], lo: np.ndarray, hi: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(row, from, to): offsets t, hi <= from <= t <= to <= lo, at which a row's window is repeated.

    ``texts[i]``: the bytes from ``lo[i]`` before the anchor on. Only rows of a group are compared.
    """
    n = len(texts)
    right = [text[k:] for text, k in zip(texts, lo.tolist())]
    order = np.array(sorted(range(n), key=lambda i: (groups[i], right[i])), np.int64)
    lengths = np.array([len(r) for r in right])
    after = np.zeros((n, length), np.uint8)
    before = np.zeros((n, int(lo.max(initial=0)) + 1), np.uint8)
    for i, (text, own, k) in enumerate(zip(texts, right, lo.tolist())):
        after[i, : min(len(own), length)] = np.frombuffer(own[:length], np.uint8)
        before[i, :k] = np.frombuffer(text[:k], np.uint8)[::-1]
    # common prefixes of neighbours in suffix order, then their minima over 2**k neighbours
    a, b = order[:-1], order[1:]
    differ = after[a] != after[b]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    prefix = np.minimum(prefix, np.minimum(lengths[a], lengths[b]))
    prefix[groups[a] != groups[b]] = -1
    minima = [prefix]
    while 2 ** len(minima) < n:
        half, last = 2 ** (len(minima) - 1), minima[-1]
        minima.append(np.minimum(last[:-half], last[half:]))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)

    def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes of rows x and y, y after x in suffix order."""
        p, q = rank[x], rank[y]
        k = np.frexp((q - p).astype(float))[1] - 1
        found = np.empty(x.size, np.int64)
        for level in np.unique(k):
            at = k == level
            found[at] = np.minimum(minima[level][p[at]], minima[level][q[at] - (1 << int(level))])
        return found

    rows, interval = order, np.cumsum(np.concatenate([[0], (groups[a] != groups[b]).astype(np.int64)]))
    open_from = np.full(n, -1)
    found: list[tuple[int, int, int]] = []
    t = 0
    while rows.size:
        same = np.flatnonzero(interval[1:] == interval[:-1])
        pair = np.full(rows.size - 1, -1)
        pair[same] = common(rows[same], rows[same + 1])
        best = np.maximum(np.append(pair, -1), np.concatenate([[-1], pair]))
        hit = (best + t >= length) & (t >= hi[rows]) & (t <= lo[rows])
        starts, ends = hit & (open_from[rows] < 0), ~hit & (open_from[rows] >= 0)
        open_from[rows[starts]] = t
        for i in rows[ends].tolist():
            found.append((i, int(open_from[i]), t - 1))
        open_from[rows[ends]] = -1
        able = (best + lo[rows] >= length) & (t < lo[rows])
        for i in rows[hit & ~able].tolist():
            found.append((i, int(open_from[i]), t))
            open_from[i] = -1
        rows, interval = rows[able], interval[able]
        step = np.argsort(interval * 256 + before[rows, t], kind="stable")
        rows, interval = rows[step], interval[step]
        byte = before[rows, t]
        interval = np.cumsum(np.concatenate([[0], ((interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1])).astype(np.int64)]))[: rows.size]
        t += 1
    return found


_RANGES = "id long, low int, high int"


def _expand(length: int) -> Callable:
    """Rows sorted by group, (grp, id, lo, hi, base, text): offsets of repeated windows by id."""

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        base = table["base"].to_numpy()
        lo = table["lo"].to_numpy()
        texts = [t[b - k :] for t, b, k in zip(table["text"].to_pylist(), base.tolist(), lo.tolist())]
        found = repeated_windows(table["grp"].to_numpy(), texts, lo.astype(np.int64), table["hi"].to_numpy().astype(np.int64), length)
        ids = table["id"].to_numpy()
        rows, low, high = (np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[rows]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["id", "low", "high"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            grp = batch["grp"].to_numpy()
            cut = int(np.flatnonzero(grp != grp[-1]).max(initial=-1)) + 1  # the last group may go on
            if cut:
                waiting.append(batch.slice(0, cut))
                size += cut
                if size >= CHUNK // 50:
                    yield solve(waiting)
                    waiting, size = [], 0
            waiting.append(batch.slice(cut))
            size += batch.num_rows - cut
        if waiting:
            yield solve(waiting)

    return run


def _halves(width: int, length: int) -> Callable:
    """Rows to the rows of their offsets' halves: the bytes all windows of a half share are its gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows = []
            for grp, id_, lo, hi, base, text in zip(*(batch[c].to_pylist() for c in ("grp", "id", "lo", "hi", "base", "text"))):
                for low in range(hi // width * width, lo + 1, width):
                    high = low + width - 1
                    core = text[base - low : base - high + length]
                    a, b = min(lo, high), max(hi, low)
                    key = digest(core + low.to_bytes(4, "little"), grp & 0xFFFFFFFFFFFFFFFF)
                    part = digest(text[base - a : base - b + length], a << 16 | b)
                    rows.append((_signed(key), id_, a, b, base, _signed(part), text))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["grp", "id", "lo", "hi", "base", "part", "text"]
            )

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _texts(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """(k1, k2, text): texts as bytes under a key of 128 bits of their own, so copies share one."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(*more, F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"), text.cast("binary").alias("text"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the texts that are about to be shuffled."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [packer.compress(text) for text in batch["text"].to_pylist()]
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()) if n == "text" else batch[n] for n in names], names=names)


def _cut_spans(length: int) -> Callable:
    """Texts with the anchors wanted from them to (grp, id, lo, hi, base, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist()):
                text = unpacker.decompress(packed)
                for w in wanted:
                    span = text[w["start"] : w["start"] + w["lo"] - w["hi"] + length]
                    rows.append((w["gram"], w["id"], w["lo"], w["hi"], w["lo"], span))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["grp", "id", "lo", "hi", "base", "text"])

    return run


_SPAN_ROWS = "grp long, id long, lo int, hi int, base int, text binary"


def _crowded(rows: DataFrame, length: int) -> DataFrame:
    """Repeated offsets (id, low, high) of rows in groups that are too large for one task."""
    spark = rows.sparkSession
    found = spark.createDataFrame([], _RANGES)
    width = 1 << (length - GRAM).bit_length()
    while width > 1:
        width //= 2
        halves = stored(rows.mapInArrow(_halves(width, length), "grp long, id long, lo int, hi int, base int, part long, text binary"), "halves")
        parts = halves.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one"))
        parts = stored(parts, "half_parts")
        whole = halves.join(parts.filter("n > 1").select("grp", "part"), ["grp", "part"])
        found = found.union(whole.select("id", F.col("hi").alias("low"), F.col("lo").alias("high")))
        sizes = parts.groupBy("grp").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1")
        if width == 1:
            break  # a half of one window is its own gram: equal ones have been found
        open_ = stored(
            halves.join(parts.select("grp", "part", F.col("one").alias("id")), ["grp", "part", "id"]).join(sizes, "grp"), "open_halves"
        )
        found = found.union(_sorted_groups(open_.filter(F.col("spans") <= CROWD), length))
        rows = open_.filter(F.col("spans") > CROWD)
        if rows.isEmpty():
            break
    return found


def _sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    columns = ["grp", "id", "lo", "hi", "base", "text"]
    return rows.select(*columns).repartition("grp").sortWithinPartitions("grp").mapInArrow(_expand(length), _RANGES)


def _covered(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(k1, k2, ranges): the byte ranges [first, last) of each text that repeated windows cover."""
    anchors = stored(_texts(docs, text_col).mapInArrow(_anchors(length), _ANCHORS), "anchors")
    spans = anchors.groupBy("gram", "span", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "start")).alias("one")
    )
    grams = spans.groupBy("gram").agg(F.count(F.lit(1)).alias("spans"), F.sum("n").alias("places")).filter("places > 1")
    spans = spans.join(grams, "gram").select("*", F.monotonically_increasing_id().alias("id"))
    spans = stored(spans, "spans")
    whole = spans.filter("n > 1").select("gram", "span", F.col("hi").alias("low"), F.col("lo").alias("high"))
    wanted = spans.filter("spans > 1").groupBy(F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2")).agg(
        F.collect_list(F.struct("gram", "id", "one.start", "lo", "hi")).alias("wanted")
    )
    texts = _texts(docs, text_col).mapInArrow(_pack, "k1 long, k2 long, text binary")
    # copies of a text are one: any of them will do
    cut = texts.join(stored(wanted, "wanted"), ["k1", "k2"]).mapInArrow(_cut_spans(length), _SPAN_ROWS)
    crowds = spans.filter(F.col("spans") > CROWD).select("id", F.lit(True).alias("crowd"))
    cut = stored(cut, "span_texts").dropDuplicates(["id"])
    crowd = cut.join(crowds, "id", "left_semi")
    found = _sorted_groups(cut.join(crowds, "id", "left_anti"), length)
    if not crowds.isEmpty():
        found = found.union(_crowded(stored(crowd, "crowd_texts"), length))
    part = found.join(spans.select("id", "gram", "span"), "id").select("gram", "span", "low", "high")
    ranges = stored(whole.union(part), "repeated_offsets")
    place = F.col("start") + F.col("lo")
    covered = (
        anchors.join(ranges, ["gram", "span"])
        .select("k1", "k2", (place - F.col("high")).alias("first"), (place - F.col("low") + length).alias("last"))
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    )
    return stored(covered, "covered")  # read back, so that a join with many copies of a text can be split


def _merge(ranges: list[dict]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for r in ranges:
        if merged and r["first"] <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], r["last"]))
        else:
            merged.append((r["first"], r["last"]))
    return merged


def _without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for first, last in ranges:
        kept.append(text[at:first])
        at = last
    return b"".join([*kept, text[at:]])


_REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _report(shorter: bool) -> Callable:
    """The counts of each text; with ``shorter`` ranges, how many bytes those cover too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            columns: list[list] = [[] for _ in range(5 + shorter)]
            for doc_id, packed, *found in zip(*(column.to_pylist() for column in batch.columns)):
                text, merged = unpacker.decompress(packed), [_merge(ranges or []) for ranges in found]
                kept = _without(text, merged[0])
                row = [doc_id, len(text), len(text) - len(kept), len(merged[0]), hashlib.sha256(kept).hexdigest()]
                row += [sum(last - first for first, last in ranges) for ranges in merged[1:]]
                for column, value in zip(columns, row):
                    column.append(value)
            types = [*[pa.int64()] * 4, pa.string(), pa.int64()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)])

    return run


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shorter: int | None = None
) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    Removed is every byte in a string of ``length`` bytes that starts at another place too, in the
    same document or any other. Strings are judged on the texts as they came. A null text is empty;
    texts shorter than ``length`` stay whole. Equal texts, whatever their doc_ids, are each other's
    repeats, so rows that repeat a longer text go whole. An empty table gives no rows. Very long texts
    are read whole; columns besides the two named are not read.
    ``shorter`` adds n_repeated, the bytes in repeated strings of that many bytes, which stay: it tells
    documents that share passages too short to be removed.
    A length below that of an anchor, GRAM bytes, is refused with a ValueError.
    """
    ship(docs.sparkSession)
    keyed = _texts(docs, text_col, docs[id_col].cast("long").alias("doc_id"))
    packed = keyed.mapInArrow(_pack, "doc_id long, k1 long, k2 long, text binary")
    covered = _covered(docs, text_col, length)
    if shorter:
        more = _covered(docs, text_col, shorter).withColumnRenamed("ranges", "shorter")
        covered = covered.join(more, ["k1", "k2"], "full_outer")
    return (
        packed.join(covered, ["k1", "k2"], "left")
        .drop("k1", "k2")
        .mapInArrow(_report(bool(shorter)), _REPORT + (", n_repeated long" if shorter else ""))
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), shorter=SHORTER)


def _rewrite(text_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names[:-1]
            texts = [
                text if text is None or not ranges else _without(text.encode(), _merge(ranges)).decode(errors="ignore")
                for text, ranges in zip(batch[text_col].to_pylist(), batch[batch.num_columns - 1].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else batch[n] for n in names], names=names)

    return run


def drop_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` with all rows and columns, the texts without what suffix_dedup removes.

    A character of which a removed string takes some bytes only goes whole. A null text stays null.
    """
    ship(docs.sparkSession)
    covered = _covered(docs, text_col, length).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("ranges").alias("__ranges"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    keyed = docs.withColumns({"__k1": F.xxhash64(text), "__k2": F.xxhash64(F.lit("second"), text)})
    joined = keyed.join(covered, ["__k1", "__k2"], "left").select(*[docs[n] for n in docs.columns], "__ranges")
    return joined.mapInArrow(_rewrite(text_col), docs.schema)
