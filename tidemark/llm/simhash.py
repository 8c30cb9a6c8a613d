"""SimHash near-dedup by the generalised pigeonhole principle."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored
from .components import roots

BITS = 64
SHINGLE = 3  # words
DISTANCE = 2  # bits
SEED = 42
CROWD = 128  # fingerprints of one bucket that are compared pair by pair


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if it is set in over half the hashes of the word shingles."""
    import xxhash

    words = text.encode().lower().split()  # of bytes, so A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 255):  # sums of 255 bits fit a byte
        bits = np.unpackbits(hashes[i : i + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, shingle) for text in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return run


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are both set, over a task's fingerprints."""
    both = np.zeros((BITS, BITS))
    for batch in batches:
        values = batch["fp"].to_numpy(zero_copy_only=False).astype("<i8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
        both += bits.T @ bits
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both[i, j].astype(np.int64))], names=["i", "j", "n"])


@dataclass(frozen=True)
class Part:
    """Bit positions and the distance within which they are probed; -1: not at all."""

    bits: tuple[int, ...]
    radius: int

    def masks(self) -> list[int]:
        chosen = (c for k in range(self.radius + 1) for c in itertools.combinations(self.bits, k))
        return [_signed(sum(1 << b for b in c)) for c in chosen]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def group_bits(correlation: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Equal parts: each grows from its first free bit by the bit most correlated with its own."""
    free, groups = list(range(len(correlation))), []
    for left in range(parts, 0, -1):
        own = [free.pop(0)]
        for _ in range(-(-(len(free) + 1) // left) - 1):
            best = max(free, key=lambda b: correlation[b, own].mean())
            own.append(best)
            free.remove(best)
        groups.append(tuple(sorted(own)))
    return groups


def near_share(differ: np.ndarray) -> np.ndarray:
    """Probability of each distance between two values whose bits differ independently."""
    share = np.array([1.0])
    for p in differ:
        share = np.convolve(share, [1 - p, p])
    return share


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Radii of least cost with the given sum; ``cost[i][r + 1]`` is that of radius r in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, radii) in best.items():
            for r, more in enumerate(own, -1):
                if used + r not in step or so_far + more < step[used + r][0]:
                    step[used + r] = (so_far + more, [*radii, r])
        best = step
    return best[total]


def choose_parts(prints: DataFrame, distance: int) -> list[Part]:
    """Parts and radii from counts over all fingerprints: 64 x 64 sums come to the driver.

    Two fingerprints within ``distance`` agree within its radius in some part whenever the radii
    sum up to distance - parts + 1. The candidates of a part at radius 0 are the pairs that meet in
    its values, counted; wider radii scale that by the shares that independent bits would give.
    """
    sums = prints.mapInArrow(_bit_sums, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS, BITS))
    for row in sums:
        both[row["i"], row["j"]] = both[row["j"], row["i"]] = row["n"]
    n = max(1.0, prints.count())
    q = both.diagonal() / n
    spread = np.sqrt(np.outer(q * (1 - q), q * (1 - q)))
    correlation = np.abs(both / n - np.outer(q, q)) / np.where(spread > 0, spread, 1)
    differ = 2 * q * (1 - q)
    choices = []
    for parts in range(2, distance + 3):
        groups = group_bits(correlation, parts)
        values = [_masked(F.col("fp"), bits) for bits in groups]
        meeting = [
            prints.groupBy(value.alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0.0
            for value in values
        ]
        cost = []
        for bits, pairs in zip(groups, meeting):
            share = np.cumsum(near_share(differ[list(bits)]))
            probes = np.cumsum([math.comb(len(bits), r) for r in range(distance + 1)])
            cost.append([0.0, *(pairs * share[r] / max(share[0], 1e-12) + n * probes[r] for r in range(distance + 1))])
        least, radii = allocate(cost, distance - parts + 1)
        choices.append((least, [Part(bits, r) for bits, r in zip(groups, radii) if r >= 0]))
    return min(choices, key=lambda choice: choice[0])[1]


def _masked(fp: Column, bits: tuple[int, ...]) -> Column:
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _flips(fp: Column, masks: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: fp.bitwiseXOR(m))


def _listed(prints: DataFrame, parts: list[tuple[int, tuple[int, ...], list[int]]]) -> DataFrame:
    """(fp, part, value): each fingerprint under its masked bits, flipped by every mask."""

    def under(part: int, bits: tuple[int, ...], masks: list[int]) -> Column:
        return F.transform(
            _flips(_masked(F.col("fp"), bits), masks), lambda v: F.struct(F.lit(part).alias("part"), v.alias("value"))
        )

    return prints.select("fp", F.explode(F.concat(*[under(*part) for part in parts])).alias("at")).select("fp", "at.*")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v) between distinct fingerprints ``fp``: connects exactly those within ``distance``.

    Buckets are looked up by probes and all members verified. A bucket of more than CROWD members is
    not compared pair by pair. Its members, and whatever probes it, go another exact way: to be within
    2 r bits is to have a common neighbour within r, so each is listed under all values within
    distance / 2, and whatever meets under one value is linked to the smallest. A value has a
    bounded number of neighbours, so those groups are small.
    """
    if distance % 2:
        raise ValueError("an even distance is needed: else two neighbours of a value may be a bit too far apart")
    parts = choose_parts(prints, distance)
    fp = F.col("fp")
    index = _listed(prints, [(i, p.bits, [0]) for i, p in enumerate(parts)])
    probe = _listed(prints, [(i, p.bits, p.masks()) for i, p in enumerate(parts)])
    sizes = index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    crowds = stored(sizes.filter(F.col("n") > CROWD).select("part", "value"), "crowds")
    exact = all(p.radius == 0 for p in parts)
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    touched = stored(probe.join(crowds, ["part", "value"], "left_semi").select("fp").distinct(), "crowded")
    index, probe = (side.join(crowds, ["part", "value"], "left_anti") for side in (index, probe))
    pairs = (
        probe.withColumnRenamed("fp", "u")
        .join(index.withColumnRenamed("fp", "v"), ["part", "value"])
        .filter((F.col("u") < F.col("v")) if exact else (F.col("u") != F.col("v")))
        .filter(near)
        .select("u", "v")
    )
    masks = [_signed(sum(1 << b for b in c)) for k in range(distance // 2 + 1) for c in itertools.combinations(range(BITS), k)]
    hubs = (
        touched.select("fp", F.explode(_flips(fp, masks)).alias("hub"))
        .groupBy("hub")
        .agg(F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
        .select(F.array_min("members").alias("u"), F.explode("members").alias("v"))
        .filter(F.col("u") != F.col("v"))
    )
    return pairs.union(hubs)


def simhash(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: (doc_id, fingerprint, component_id).

    component_id: the smallest doc_id among all rows whose fingerprints are linked, step by step,
    by at most ``distance`` differing bits. Texts without a word, null ones too, have fingerprint
    zero and are linked like any other. A null doc_id is no candidate for component_id. Repeated
    rows share a fingerprint; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).mapInArrow(_fingerprints(shingle), "doc_id long, fp long")
    rows = stored(rows, "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    tied = stored(roots(links(prints.select("fp"), distance)), "roots")
    rooted = prints.join(tied.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir))


def drop_near(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose doc_id is the component_id of their group.

    Rows that share a doc_id stay or go together; rows without one stay, as nothing names them.
    """
    found = simhash(docs, shingle, distance, id_col, text_col)
    gone = stored(found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__id")).distinct(), "near_copies")
    return docs.join(gone, docs[id_col].cast("long") == gone["__id"], "left_anti")
