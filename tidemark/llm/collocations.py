"""Phrases of two to five words that stand together more often than their parts would.

Counting, per language, in three passes over the texts:

1. Words are counted (and given 64-bit keys, checked to be distinct).
2. Pairs of words that are frequent, and 3. windows of up to five words in which every pair is
   frequent, are counted by a multikey three-way quicksort of suffix pointers to that depth. Windows
   are routed to groups by their leading words: the first one, the first two where the first is HOT,
   or all where these are hot too, so that no group is large; equal windows of a task travel as one
   with its count. In a group, pointers are split by the word at their depth into smaller, equal and
   larger ones; the equal ones' number is the count of the phrase up to there, and they go on with
   the next word. Parts that hold fewer than the least count are abandoned, unless their phrase is
   spread over groups; such partial counts are added up afterwards.

What is frequent reaches the workers as a bitmap of hashes. Its size follows the number of frequent
words or pairs up to BITMAP_BITS; false hits cost some shuffling, and are counted like all others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, ship, stored

DEPTH = 5  # words
LEAST = 100  # occurrences
TOP = 2000  # phrases of a language
CHUNK = 8 << 20  # bytes of text that are encoded together
GROUP = 1 << 18  # windows of a group, on average
HOT, HOT_SHARE = 1 << 16, 1 << 19  # hot: more than HOT occurrences, or one in HOT_SHARE of all words
BITMAP_BITS = 1 << 30  # 128 MB
KEEP = 500_000  # words that a worker remembers
NO_LANG = "und"

U = np.uint64
_BREAK, _NOTHING = 0, 1  # in place of keys: the end of a piece, no word at all

# Bytes that end a piece, and those that end a word.
_ENDS, _GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_PLAIN = bytes.maketrans(
    _ENDS + _GAPS + bytes(range(0x41, 0x5B)), b"\n" * len(_ENDS) + b" " * len(_GAPS) + bytes(range(0x61, 0x7B))
)


class WordKeys(dict):
    """word -> key, for one language."""

    def __init__(self, lang: str, seed: int):
        import xxhash

        super().__init__({b"": _NOTHING, b"\n": _BREAK})
        self.begin, self.seed, self.digest = lang.encode() + b"\0", seed, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        found = max(self.digest(self.begin + word, self.seed), 2)
        self[word] = found
        return found


def tokens_of(texts: list[str]) -> list[bytes]:
    """Words, b"\\n" where a piece ends, and b"" for nothing."""
    return "\n".join(texts).encode().translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[str]]]:
    """Texts of some CHUNK bytes at a time, by language."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _count_words(seed: int) -> Callable:
    """Texts to (phrase, lang, word, n); the phrase is the word's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _by_lang(batches):
            for lang, texts in chunk.items():
                counts = Counter(tokens_of(texts))
                counts.pop(b"", None)
                counts.pop(b"\n", None)
                keys = WordKeys(lang, seed)
                phrases = np.fromiter(map(keys.__getitem__, counts), ">u8", len(counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([phrases[i : i + 1].tobytes() for i in range(len(counts))], pa.binary()),
                        pa.array([lang] * len(counts), pa.string()), pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                        pa.array(counts.values(), pa.int64()),
                    ],
                    names=["phrase", "lang", "word", "n"],
                )

    return run


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0x9E3779B97F4A7C15)
    return h ^ (h >> U(29))


def prefix_hashes(windows: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first 1, 2, ... words of each window."""
    found = [_mix(windows[:, 0])]
    for j in range(1, windows.shape[1]):
        found.append(_mix(found[-1] * U(0xC2B2AE3D27D4EB4F) + windows[:, j]))
    return found


class Filter:
    """Which hashes may be frequent."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, U(bits.size * 8 - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[at >> U(3)] >> (at & U(7)).astype(np.uint8) & 1).astype(bool)


def cut_windows(keys: np.ndarray, depth: int, words: Filter, pairs: Filter | None) -> np.ndarray:
    """The next ``depth`` words from each word on, 0 beyond the piece or from where a word, or a pair
    of neighbours, is not frequent. Without ``pairs`` windows have two words or more, else three."""
    keys = np.append(keys[keys != _NOTHING], np.zeros(depth, U))
    keys[~words(_mix(keys))] = _BREAK
    n = keys.size - depth
    windows = np.stack([keys[j : j + n] for j in range(depth)], axis=1)
    joined = (keys[:-1] != 0) & (keys[1:] != 0)
    if pairs:
        joined[joined] = pairs(_mix(_mix(keys[:-1][joined]) * U(0xC2B2AE3D27D4EB4F) + keys[1:][joined]))
    going = windows[:, 0] != 0
    for j in range(1, depth):
        going &= joined[j - 1 : j - 1 + n]
        windows[~going, j] = 0
    return windows[windows[:, 2 if pairs else 1] != 0]


def _equal_once(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows with their numbers; where hashes clash, one may be given in parts."""
    order = np.argsort(prefix_hashes(windows)[-1], kind="stable")
    windows = windows[order]
    first = np.flatnonzero(np.append(True, (windows[1:] != windows[:-1]).any(axis=1)))
    return windows[first], np.diff(np.append(first, windows.shape[0])).astype(np.uint32)


def _pack(windows: np.ndarray, counts: np.ndarray, spread: np.ndarray) -> bytes:
    keys, at = np.unique(windows, return_inverse=True)
    at = at.reshape(windows.shape).T.astype("<u4").tobytes()
    head = np.array([keys.size, windows.shape[0]], "<u4").tobytes()
    return zstandard.compress(head + keys.astype("<u8").tobytes() + at + counts.astype("<u4").tobytes() + spread.astype(np.uint8).tobytes(), 1)


def _unpack(packed: bytes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.decompress(packed)
    n_keys, n = np.frombuffer(data, "<u4", 2).tolist()
    keys = np.frombuffer(data, "<u8", n_keys, 8)
    at = np.frombuffer(data, "<u4", n * depth, 8 + 8 * n_keys).reshape(depth, n)
    counts = np.frombuffer(data, "<u4", n, 8 + 8 * n_keys + 4 * n * depth)
    spread = np.frombuffer(data, np.uint8, n, 8 + 8 * n_keys + 4 * n * (depth + 1))
    return keys[at.T], counts, spread


def _route(seed: int, depth: int, groups: int, words, pairs, hot) -> Callable:
    """Texts to (grp, windows): the windows of a chunk that go to one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, WordKeys] = {}
        frequent, joined = Filter(words.value), Filter(pairs.value) if pairs else None
        hot_words, hot_pairs = hot.value
        for chunk in _by_lang(batches):
            parts = []
            for lang, texts in chunk.items():
                tokens = tokens_of(texts)
                keys = langs.setdefault(lang, WordKeys(lang, seed))
                parts.append(cut_windows(np.fromiter(map(keys.__getitem__, tokens), U, len(tokens)), depth, frequent, joined))
                if sum(map(len, langs.values())) > KEEP:
                    langs.clear()
            windows = np.concatenate(parts)
            if not len(windows):
                continue
            windows, counts = _equal_once(windows)
            hashes = prefix_hashes(windows)
            # the words that decide the route; phrases of fewer words are spread over groups
            spread = np.where(np.isin(hashes[0], hot_words), 2, 1)
            if depth > 2:
                spread[(spread == 2) & np.isin(hashes[1], hot_pairs)] = depth
            route = np.choose(np.minimum(spread - 1, 2), [hashes[0], hashes[1], hashes[-1]])
            group = (_mix(route + U(depth)) % U(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            ends = np.flatnonzero(np.append(np.diff(group[order]) != 0, True)) + 1
            starts = np.append(0, ends[:-1])
            packed = [_pack(windows[o], counts[o], spread[o]) for o in (order[a:b] for a, b in zip(starts, ends))]
            yield pa.RecordBatch.from_arrays([pa.array(group[order[starts]]), pa.array(packed, pa.binary())], names=["grp", "windows"])

    return run


def frequent_prefixes(windows: np.ndarray, counts: np.ndarray, spread: np.ndarray, least: int, shortest: int) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """(windows' numbers, words, counts) of the phrases that windows begin with.

    Phrases of ``shortest`` words or more that begin windows of ``least`` occurrences in all; also
    those of fewer words than the windows' ``spread``, whatever their count. All parts of the pointer
    array are split side by side, each by the median of its first, middle and last word.
    """
    depth = windows.shape[1]
    pointer = np.arange(windows.shape[0])
    part, at = np.zeros(pointer.size, np.int64), np.zeros(1, np.int64)  # part of a pointer, depth of a part
    found = []
    while pointer.size:
        ends = np.cumsum(np.bincount(part))
        starts = np.append(0, ends[:-1])
        word = windows[pointer, at[part]]
        pivot = np.sort(np.stack([word[starts], word[(starts + ends) // 2], word[ends - 1]]), axis=0)[1][part]
        side = 1 + (word > pivot).astype(np.int64) - (word < pivot)
        split = 3 * part + side
        size = np.bincount(split, minlength=3 * at.size)
        base = np.cumsum(size) - size
        place = np.empty(pointer.size, np.int64)
        for k in range(3):
            own = np.flatnonzero(side == k)
            before = np.cumsum(size[k::3]) - size[k::3]
            place[own] = (base[k::3] - before)[part[own]] + np.arange(own.size)
        moved, order = np.empty_like(pointer), np.empty_like(split)
        moved[place], order[place] = pointer, split
        some = np.flatnonzero(size)
        number = np.bincount(order, weights=counts[moved], minlength=size.size).astype(np.int64)
        wide = np.zeros(size.size, np.int64)
        wide[some] = np.maximum.reduceat(spread[moved].astype(np.int64), base[some])
        deeper = np.repeat(at, 3)
        deeper[1::3] += 1
        equal = some[some % 3 == 1]
        told = equal[(deeper[equal] >= shortest) & ((number[equal] >= least) | (wide[equal] > deeper[equal]))]
        for words in np.unique(deeper[told]).tolist():
            own = told[deeper[told] == words]
            found.append((moved[base[own]], words, number[own]))
        # nothing that begins in an abandoned part can be frequent
        going = (size > 0) & (deeper < depth) & ((number >= least) | (wide > deeper + 1))
        stay = going[order]
        pointer, order = moved[stay], order[stay]
        stay = windows[pointer, deeper[order]] != 0
        pointer, order = pointer[stay], order[stay]
        kept, part = np.unique(order, return_inverse=True)
        at = deeper[kept]
    return found


_COUNTED = "phrase binary, size int, hash long, n long"


def _solve(depth: int, least: int, shortest: int) -> Callable:
    """(grp, windows) sorted by group to the counts of phrases."""

    def of_group(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        windows, counts, spread = map(np.concatenate, zip(*(_unpack(p, depth) for p in packed)))
        hashes = prefix_hashes(windows)
        for rows, words, number in frequent_prefixes(windows, counts, spread, least, shortest):
            text = windows[rows, :words].astype(">u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([text[i : i + 8 * words] for i in range(0, len(text), 8 * words)], pa.binary()),
                    pa.array(np.full(rows.size, words, np.int32)), pa.array(hashes[words - 1][rows].view(np.int64)), pa.array(number),
                ],
                names=["phrase", "size", "hash", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for grp, packed in zip(batch["grp"].to_pylist(), batch["windows"].to_pylist()):
                if grp != group and held:
                    yield from of_group(held)
                    held = []
                group = grp
                held.append(packed)
        if held:
            yield from of_group(held)

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the column ``hash``, of a power of two bits; one row per 32,768 bits is collected."""
    members = hashes.count()
    bits = 1 << min(max((16 * members).bit_length(), 15), BITMAP_BITS.bit_length() - 1)
    place = F.col("hash").bitwiseAND(bits - 1) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = np.zeros(bits // 8, np.uint8)
    for part, own in parts.collect():
        found[(part - 1) * 4096 : part * 4096] = np.frombuffer(own, np.uint8)
    return found


def _hashes_over(counted: DataFrame, n: int) -> np.ndarray:
    """Hashes of what occurs more than ``n`` times: no more than all occurrences divided by ``n``."""
    return counted.filter(F.col("n") > n).select("hash").toArrow()["hash"].to_numpy().view(U)


def _counts(rows: DataFrame, seed: int, depth: int, total: int, least: int, words, pairs, hot) -> DataFrame:
    """(phrase, size, hash, n) of all phrases of up to ``depth`` words that occur ``least`` times."""
    groups = 1 + total // GROUP
    routed = rows.mapInArrow(_route(seed, depth, groups, words, pairs, hot), "grp long, windows binary")
    solved = routed.repartition("grp").sortWithinPartitions("grp").mapInArrow(_solve(depth, least, 3 if pairs else 2), _COUNTED)
    summed = solved.groupBy("phrase").agg(F.first("size").alias("size"), F.first("hash").alias("hash"), F.sum("n").alias("n"))
    return stored(summed.filter(F.col("n") >= least), "phrases")


def _word_counts(rows: DataFrame) -> tuple[DataFrame, int]:
    """(phrase, lang, word, n) of all words, and the seed of their keys.

    Keys are tried with one seed after the other until no two words share one.
    """
    seed = 0
    while True:
        each = rows.mapInArrow(_count_words(seed), "phrase binary, lang string, word string, n long")
        word = F.struct("lang", "word")
        counted = each.groupBy("phrase").agg(F.min(word).alias("one"), F.max(word).alias("other"), F.sum("n").alias("n"))
        counted = stored(counted, "words")
        if counted.filter("one != other").isEmpty():
            return counted.select("phrase", "one.lang", "one.word", "n"), seed
        seed += 1


def _key(phrase: str, first: Column | int, words: Column | int) -> Column:
    """``words`` words of a phrase from one on, as a phrase."""
    return F.substring(F.col(phrase), F.lit(8) * first + 1, F.lit(8) * words)


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(phrase, size, lang, a, l, r, n, score) by the lowest-scoring cut; sums and products are exact."""
    counted = words.select("phrase", "n").unionByName(phrases.select("phrase", "n"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    langs = words.select(F.col("phrase").alias("first"), "lang")
    longer = phrases.select("phrase", "size", F.col("n").alias("a")).withColumn("first", _key("phrase", 0, 1)).join(langs, "first").join(totals, "lang")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": _key("phrase", 0, F.col("k")), "right": _key("phrase", F.col("k"), F.col("size") - F.col("k"))})
    both = cuts.join(counted.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(
        counted.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right"
    )
    wide = [f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "total", "l", "r")]
    score = F.expr("(1000 * {} * {}) DIV ({} * {})".format(*wide))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("phrase", "size", "lang", "a", F.col("total").alias("n")).agg(best).select(
        "phrase", "size", "lang", "a", "best.l", "best.r", "n", "best.score"
    )


def _not_contained(phrases: DataFrame) -> DataFrame:
    """Phrases that no phrase of one more word always holds; longer ones would show in that one."""
    inner = phrases.filter("size > 2").select(
        F.explode(F.array(_key("phrase", 0, F.col("size") - 1), _key("phrase", 1, F.col("size") - 1))).alias("phrase"), "n"
    )
    inner = inner.groupBy("phrase").agg(F.max("n").alias("held"))
    joined = phrases.join(inner, "phrase", "left")
    return joined.filter("held IS NULL OR held < n").select("phrase")


def collocations(
    docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\n-\\r]`` and into words at spaces and
    tabs. Candidates are phrases of 2 to ``depth`` words that occur ``least`` times; the score of a cut
    is floor(1000 a n / (l r)), a phrase's that of its lowest cut, the first of equals. Phrases that
    lie in a longer one of the same count are dropped. Ties rank by ``a``, then by the phrase's bytes.

    A null text is empty, a null language is ``und``; other columns are ignored, doc_ids too. Very
    long texts, and very long words, are encoded whole; repeated texts count as often as they stand.
    No rows, or no frequent phrase, gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast
    rows = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )
    words, seed = _word_counts(rows)
    total = words.agg(F.sum("n")).first()[0] or 0
    hot_from = max(HOT, total // HOT_SHARE)
    often = stored(
        words.filter(F.col("n") >= least).select("phrase", "n").mapInArrow(_hash_words, "hash long, n long"), "frequent_words"
    )
    frequent, hot_words = share(_bitmap(often)), _hashes_over(often, hot_from)
    none = np.zeros(0, U)
    pairs = _counts(rows, seed, 2, total, least, frequent, None, share((hot_words, none)))
    phrases = pairs
    if depth > 2:
        joined, hot_pairs = share(_bitmap(pairs)), _hashes_over(pairs, hot_from)
        phrases = pairs.unionByName(_counts(rows, seed, depth, total, least, frequent, joined, share((hot_words, hot_pairs))))
    scored = _scored(phrases, words).join(_not_contained(phrases), "phrase", "left_semi")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    leading = scored.withColumn("rank", F.rank().over(by_score)).filter(F.col("rank") <= top)
    keys = leading.select("phrase", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: _key("phrase", i, 1))).alias("i", "key"))
    spelled = (
        keys.join(words.select(F.col("phrase").alias("key"), "word"), "key")
        .groupBy("phrase")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("text"))
    )
    by_text = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = leading.join(spelled, "phrase").withColumn("rank", F.row_number().over(by_text).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.frombuffer(b"".join(batch["phrase"].to_pylist()), ">u8").astype(U)
        yield pa.RecordBatch.from_arrays([pa.array(_mix(keys).view(np.int64)), batch["n"]], names=["hash", "n"])


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP11_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), runs AS (
    SELECT lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS phrase
    FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), counted AS (
    SELECT lang, phrase, count(*) AS f FROM runs GROUP BY lang, phrase HAVING count(*) >= 100
), inner_phrases AS (
    SELECT lang, unnest([phrase[1:len(phrase) - 1], phrase[2:len(phrase)]]) AS phrase, f FROM counted WHERE len(phrase) > 2
), held AS (
    SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY lang, phrase
), cuts AS (
    SELECT lang, phrase, f, unnest(range(1, len(phrase))) AS k FROM counted WHERE len(phrase) > 1
), scored AS (
    SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
           (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c
    JOIN counted x ON x.lang = c.lang AND x.phrase = c.phrase[1:c.k]
    JOIN counted y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1:len(c.phrase)]
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, b.a, b.l, b.r, b.n, b.score::BIGINT AS score
    FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
    WHERE h.f IS NULL OR h.f < b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= 2000
"""
