"""Packing token sequences into windows by non-negative least squares over a length histogram."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored
from .word_ids import word_ids

WINDOW = 4096

Plan = list[tuple[int, tuple[int, ...]]]  # how often, lengths in a window


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int, seeds: int = 3) -> list[tuple[int, ...]]:
    """Combinations of at most three lengths that fill a window, the longest length first.

    Every length leads one combination for each of its most frequent partners: a single length that
    completes it, or a half-way length with the one that completes both.
    """
    count = np.zeros(window + 1, np.int64)
    count[lengths] = counts
    found = {(window,)} if count[window] else set()
    for a in lengths[lengths < window]:
        rest = window - a
        if count[rest]:
            found.add(tuple(sorted((int(a), int(rest)), reverse=True)))
        middle = np.arange(1, rest // 2 + 1)
        able = np.minimum(count[middle], count[rest - middle])
        for b in middle[np.argsort(-able, kind="stable")[:seeds]]:
            if count[b] and count[rest - b]:
                found.add(tuple(sorted((int(a), int(b), int(rest - b)), reverse=True)))
    return sorted(found, reverse=True)


def solve_counts(combos: list[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared error of A x against the histogram.

    A has a column for each combination and a row for each length. Cyclic coordinate descent: each
    step solves one combination exactly and keeps it non-negative. Ends when no count moves by half.
    """
    where = {int(n): i for i, n in enumerate(lengths)}
    residual = counts.astype(float).copy()
    columns = []
    for combo in combos:
        own = Counter(where[n] for n in combo)
        columns.append((np.array(list(own)), np.array(list(own.values()), float)))
    x = np.zeros(len(combos))
    for _ in range(rounds):
        moved = 0.0
        for j, (rows, times) in enumerate(columns):
            step = max(-x[j], residual[rows] @ times / (times @ times))
            if step:
                x[j] += step
                residual[rows] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return x


def greedy(counts: dict[int, int], window: int) -> Plan:
    """Best fit, longest first, over a histogram: each window found is repeated while stocks last.

    A window is also full at a power of two, which needs no padding; if no rest fits, it stays open.
    """
    left = {n: c for n, c in counts.items() if c}
    plan = []
    while left:
        keys = sorted(left)
        own: Counter[int] = Counter()
        room = window
        while room:
            i = np.searchsorted(keys, room, side="right") - 1
            while i >= 0 and own[keys[i]] >= left[keys[i]]:
                i -= 1
            if i < 0:
                break
            own[keys[i]] += 1
            room -= keys[i]
        times = min(left[n] // c for n, c in own.items())
        plan.append((times, tuple(own.elements())))
        for n, c in own.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def make_plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Windows that use up a histogram of lengths (1 to ``window``) exactly."""
    left = {n: c for n, c in counts.items() if c}
    plan: Plan = []
    if left:
        lengths = np.array(sorted(left))
        amounts = np.array([left[n] for n in lengths.tolist()])
        combos = combinations(lengths, amounts, window)
        for times, combo in sorted(zip(np.rint(solve_counts(combos, lengths, amounts)).astype(int), combos), reverse=True):
            # rounding up can overdraw a length by a few: take what is there
            times = min([int(times), *(left.get(n, 0) // c for n, c in Counter(combo).items())])
            if times > 0:
                plan.append((times, combo))
                for n in combo:
                    left[n] -= times
        plan += greedy(left, window)
    return plan


def _pieces(path: str, window: int):
    """Documents to pieces: full windows and a rest; ``nth`` numbers a task's pieces of each length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = np.frombuffer(ids.of(text), "<u2").astype("<u4")
                for start in range(0, own.size, window):
                    piece = own[start : start + window]
                    rows.append((doc_id, start, piece.size, zlib.crc32(piece), own.size, part, seen[piece.size]))
                    seen[piece.size] += 1
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES)], names=_PIECE_NAMES)

    return cut


_PIECE_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
_PIECE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
_PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"


def _slots(plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, repeats, first sequence, offset) of every place in the plan's windows."""
    rows, used, sequence = [], Counter(), 0
    for times, combo in plan:
        offset = 0
        for length in combo:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return rows


def pack(
    docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document longer than a window is cut into full windows and a rest. Only the histogram of
    lengths, at most ``window`` rows, comes to the driver; the plan's places, a few per length, go
    back. A piece finds its place by its rank among the pieces of its length: its number within its
    task plus the numbers of the tasks before, so no length, however frequent, meets in one task.

    A null text is empty and gives the end id alone. Null and repeated doc_ids are packed as they
    come, one document per row. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = id_and_text(docs, id_col, text_col)
    pieces = stored(rows.mapInArrow(_pieces(vocabulary or default_vocabulary(), window), _PIECE_SCHEMA), "pieces")
    totals = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = stored(totals, "piece_counts")
    histogram = {r["length"]: r["n"] for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        _slots(make_plan(histogram, window)), "length long, first long, times long, sequence long, offset long"
    )
    before = totals.selectExpr(
        "part", "length", "sum(n) over (partition by length order by part) - n as before"
    )
    # one row per task, length and place: the ranks that both share
    spans = (
        before.join(totals, ["part", "length"])
        .join(F.broadcast(slots), "length")
        .filter("first < before + n and before < first + times")
        .groupBy("part", "length")
        .agg(
            F.first("before").alias("before"),
            F.sort_array(F.collect_list(F.struct("first", "times", "sequence", "offset"))).alias("places"),
        )
    )
    ranked = pieces.join(spans, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    place = F.element_at(F.filter("places", lambda p: p["first"] <= F.col("rank")), -1)
    return ranked.withColumn("place", place).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("place.sequence") + F.col("rank") - F.col("place.first")).alias("sequence_id"),
        F.col("place.offset").alias("offset"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
