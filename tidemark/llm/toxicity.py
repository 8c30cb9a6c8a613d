"""Toxicity scores of deobfuscated text.

Disguised words are read as the output of a noisy channel: letters may have been written as digits or
symbols, repeated, or spaced out. A lattice of what each character may stand for is decoded by Viterbi
under a character trigram model of the whole corpus; each separator may be dropped or be a space, so
letters written one by one fall into words. The restored text is scored by words and word
beginnings whose share of toxic documents, among labelled training rows, is certainly high.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored

SAMPLE = 40_000  # labelled rows at most that the classifier is fitted on, in the order of a hash
FEATURE_LETTERS = 40  # of a word, at most, that is a feature whole; of a longer one, its beginnings are
PREFIXES = (4, 5, 6)  # letters of word beginnings
LEAST_TOXIC = 4  # toxic sampled rows that must show a feature
LEAST_SHARE = 0.6  # of a feature's rows, by its lower bound
Z = 2.4  # standard errors to that bound
PREDICT = 0.3  # score from which on a document is predicted to be toxic

#: What characters are written for: fixed table of common disguises.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
SUBSTITUTED, DROPPED, KEPT, REPEATED, LITERAL = math.log(0.3), math.log(0.3), math.log(0.3), math.log(0.3), math.log(0.001)
REMEMBERED = 64  # characters at most of a word whose decoding is cached

_LEET = "".join(map(re.escape, LEET))
#: A word with a disguised letter beside a real one; letters one by one; a letter three times or more.
DISGUISED = re.compile(
    rf"(?<!\w)(?=[a-z{_LEET}.*_-]*[a-z])(?=[a-z.*_-]*[{_LEET}*])[a-z{_LEET}.*_-]{{3,}}(?!\w)"
    r"|(?<!\w)[a-z0-9@$!](?:[ .*_-]+[a-z0-9@$!](?!\w)){3,}"
    r"|(?<!\w)[a-z]*([a-z])\1\1[a-z]*(?!\w)"
)
WORD = re.compile(r"[^\W\d_]+")
_ORDER = {c: i for i, c in enumerate(" abcdefghijklmnopqrstuvwxyz", 0)}
_LETTERS = 28  # space, a-z, any other letter


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


class Decoder:
    """Restores disguised words under log probabilities of letter trigrams."""

    def __init__(self, trigrams: np.ndarray, lexicon: dict[str, float] | None = None):
        counts = trigrams.reshape(_LETTERS, _LETTERS, _LETTERS) + 0.0
        scale = counts.sum() / 1000 + 1
        for word in lexicon or ():  # known words count as a thousandth of the corpus each
            codes = [0, 0, *(_ORDER.get(c, 27) for c in word), 0]
            for a, b, c in zip(codes, codes[1:], codes[2:]):
                counts[a, b, c] += scale
        pairs = counts.sum(axis=0, keepdims=True)
        pairs = (pairs + 0.1) / (pairs + 0.1).sum(axis=2, keepdims=True)
        mixed = (counts + 3 * pairs) / (counts.sum(axis=2, keepdims=True) + 3)
        self.log = np.log(mixed).tolist()
        self.cache: dict[str, str] = {}

    def restore(self, text: str) -> str:
        return DISGUISED.sub(self._match, text)

    def _match(self, match: re.Match) -> str:
        word = match.group()
        found = self.cache.get(word)
        if found is None:
            found = self.decode(word)
            if len(word) <= REMEMBERED:
                if len(self.cache) > 100_000:
                    self.cache.clear()
                self.cache[word] = found
        return found

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """For each run of equal characters: what it may stand for, and the channel's log probability."""
        steps = []
        for run in re.finditer(r"(.)\1*", word, re.S):
            char, times = run.group(1), run.end() - run.start()
            letters = [char] if char in _ORDER and char != " " else list(LEET.get(char, ""))
            cost = 0.0 if char in _ORDER else SUBSTITUTED
            options = [(c * k, cost + (0.0 if k == times else REPEATED)) for c in letters for k in (1, 2) if k <= times]
            if char in " .*_-":
                options += [("", DROPPED), (" ", KEPT)]
            if char == "*":
                options += [(c, SUBSTITUTED + math.log(1 / 26)) for c in "aeiou"]
            steps.append(options or [(char, LITERAL)])
        return steps

    def decode(self, word: str) -> str:
        # by the last two letters: log probability, and the path back as (letters, path before)
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in self.lattice(word):
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for state, (so_far, path) in best.items():
                for chars, cost in options:
                    (a, b), p = state, so_far + cost
                    for c in chars:
                        code = _ORDER.get(c, 27)
                        p += self.log[a][b][code]
                        a, b = (b, code) if code else (0, 0)  # a word begins as a text does
                    if (a, b) not in step or p > step[a, b][0]:
                        step[a, b] = (p, (chars, path) if chars else path)
            best = step
        path = max(best.items(), key=lambda item: item[1][0] + self.log[item[0][0]][item[0][1]][0])[1][1]
        out = []
        while path:
            chars, path = path
            out.append(chars)
        return "".join(reversed(out))


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(256, np.int64)
    for code in range(26):
        table[97 + code] = table[65 + code] = code + 1
    table[128:] = 27
    counts = np.zeros(_LETTERS**3, np.int64)
    for batch in batches:
        for text in batch["text"].to_pylist():
            codes = table[np.frombuffer(b"  " + text.encode() + b" ", np.uint8)]
            counts += np.bincount((codes[:-2] * _LETTERS + codes[1:-1]) * _LETTERS + codes[2:], minlength=counts.size)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["place", "n"])


def features(word: str) -> list[str]:
    """The word and its beginnings; of a word of more than FEATURE_LETTERS the beginnings alone."""
    return [*([word] if len(word) <= FEATURE_LETTERS else []), *(f"{word[:k]}~" for k in PREFIXES if len(word) > k)]


def _words(decoder: Decoder, text: str) -> set[str]:
    return set(WORD.findall(decoder.restore(text.lower())))


def _count_features(decoder: Broadcast) -> Callable:
    """How many rows show each feature, toxic ones apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder(decoder.value)
        toxic, every = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            names = list(every)
            counts = [[toxic[f] for f in names], [every[f] for f in names]]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array(c, pa.int64()) for c in counts)], names=["feature", "toxic", "rows"]
            )

        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = {f for word in _words(own, text) for f in features(word)}
                every.update(found)
                if label:
                    toxic.update(found)
                if len(every) > 500_000:
                    yield flush()
                    toxic.clear()
                    every.clear()
        yield flush()

    return run


def lower_bound(toxic: float, rows: float, z: float = Z) -> float:
    """Of a share, by Wilson's interval."""
    share, spread = toxic / rows, z * z / rows
    return (share + spread / 2 - math.sqrt(spread * (share * (1 - share) + spread / 4))) / (1 + spread)


def _score(model: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        decoder, weights, rest = Decoder(m["trigrams"], m["weights"]), m["weights"], m["rest"]
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch["text"].to_pylist():
                found: set[str] = set()
                for word in _words(decoder, text):
                    own = known.get(word)
                    if own is None:
                        if len(known) > 500_000:
                            known.clear()
                        own = known[word] = tuple(f for f in features(word) if f in weights)
                    if own:
                        found.update(own)
                innocent = 1 - rest
                for f in found:
                    innocent *= 1 - weights[f]
                scores.append(1 - innocent)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, held_out, score, predicted).

    ``labels``: (doc_id, toxic). Rows that held_out() names are never learnt from, nor are rows or
    labels without a doc_id, or labels that are null. Of labels repeated for a doc_id the largest
    counts. score: 1 - (1 - rest) * product of (1 - share) over the features found, rest being the
    toxic share among sampled rows that show none. A null or empty text shows none and scores rest;
    without labels every score is 0. Repeated rows score alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = id_and_text(docs, id_col, text_col)
    counts = np.zeros(_LETTERS**3)
    for r in rows.mapInArrow(_trigrams, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    trigrams = spark.sparkContext.broadcast(counts)

    learnt = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic is not null")
        .filter(F.crc32(F.col("id").cast("string")) % 4 != 2)
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"))
        .limit(SAMPLE)
    )
    sample = stored(rows.join(F.broadcast(learnt), F.col("doc_id") == F.col("id")).select("text", "toxic"), "labelled")
    found = sample.mapInArrow(_count_features(trigrams), "feature string, toxic long, rows long")
    summed = found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))
    # Each feature is certain only if LEAST_TOXIC of SAMPLE rows show it: the words of the toxic rows bound their number
    weights = {
        r["feature"]: share
        for r in summed.filter(F.col("toxic") >= LEAST_TOXIC).filter(F.col("toxic") >= LEAST_SHARE * F.col("rows")).toLocalIterator()
        if (share := lower_bound(r["toxic"], r["rows"])) >= LEAST_SHARE
    }

    model = {"trigrams": counts, "weights": weights, "rest": 0.0}
    plain = sample.select(F.col("toxic").cast("long").alias("doc_id"), "text")
    bare = plain.mapInArrow(_score(spark.sparkContext.broadcast(model)), "doc_id long, score double").filter("score = 0")
    n, toxic = bare.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_id"), F.lit(0))).first()
    model["rest"] = (toxic + 1) / (n + 20) if n else 0.0
    scored = rows.mapInArrow(_score(spark.sparkContext.broadcast(model)), "doc_id long, score double")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
