"""Token counts of whole texts without their ids: pieces are counted once per distinct pre-token.

1. Texts are cut into pre-tokens where no piece of the vocabulary can span the cut: before white
   space, around line ends, and where letters or digits are followed by something else. Merges of
   the model never cross such a cut, so a text has as many pieces as its pre-tokens have.
2. Tasks send every distinct pre-token with the number of its documents; the library counts the
   pieces of each distinct one once.
3. Documents are cut again into pre-token frequencies. The HEAD most common short pre-tokens reach
   the workers as a table of bounded size; all others are joined, whatever their number and length,
   and are by then spread over many documents, so no key is hot.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored

LIMIT = 4096  # tokens beyond which a document is over the limit
HEAD = 200_000  # pre-tokens that are broadcast, each of at most HEAD_BYTES: 9.6 MB of text and counts
HEAD_BYTES = 40
GATHER = 400_000  # distinct pre-tokens that a task holds before it sends them on

_SPACE = "▁"  # how the library spells a space


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCounts:
    """Pre-tokens of texts, and their numbers of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        special = (self.library.is_byte, self.library.is_control, self.library.is_unknown)
        pieces = [self.library.id_to_piece(i).replace(_SPACE, " ") for i in range(size) if not any(f(i) for f in special)]
        # characters that some piece holds before a cut count as "something else"
        apart = {a for p in pieces for a, b in zip(p, p[1:]) if a.isalnum() and not b.isalnum()}
        word = f"[^\\W_{re.escape(''.join(sorted(apart)))}]" if apart else "[^\\W_]"
        other = f"(?:(?!{word})[^ \\n])"
        self.cut = re.compile(f"\\n+| +{other}*{word}*|{other}+{word}*|{word}+").findall
        if any(self.cut(p) != [p] for p in pieces):
            raise ValueError("the vocabulary has pieces that span the cuts of pre-tokens")
        # what one line end before a pre-token adds; a space is added by the library itself
        self.line_end = len(self.library.encode("\n"))
        self.space = len(self.library.encode("a ")) - len(self.library.encode("a"))

    def pre_tokens(self, text: str) -> list[str]:
        """In order; the library puts a space before every text that is not empty."""
        return self.cut(" " + text.replace(_SPACE, " ")) if text else []

    def count(self, pre_token: str) -> int:
        if pre_token == " ":
            return self.space
        if pre_token[0] == " ":
            return len(self.library.encode(pre_token[1:]))
        return len(self.library.encode("\n" + pre_token)) - self.line_end


@functools.lru_cache(maxsize=1)
def piece_counts(path: str) -> PieceCounts:
    """One per worker."""
    return PieceCounts(path)


def _distinct(path: str) -> Callable:
    """Texts to (pre_token, docs): in how many of the task's documents it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        held: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.large_string()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["pre_token", "docs"]
            )

        for batch in batches:
            for text in batch["text"].to_pylist():
                held.update(set(counts.pre_tokens(text)))
                if len(held) > GATHER:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    return run


def _count_once(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        for batch in batches:
            pieces = [counts.count(p) for p in batch["pre_token"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["pre_token"], batch["docs"], pa.array(pieces, pa.int64())], names=["pre_token", "docs", "pieces"]
            )

    return run


_FREQUENCIES = "row long, doc_id long, n_bytes long, head long, rest array<string>, n array<long>"


def _frequencies(path: str, head) -> Callable:
    """Documents with the pieces of their common pre-tokens, and the frequencies of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = piece_counts(path), head.value
        for batch in batches:
            heads, rests, numbers = [], [], []
            for text in batch["text"].to_pylist():
                total, rest = 0, {}
                for pre_token, n in Counter(counts.pre_tokens(text)).items():
                    pieces = known.get(pre_token)
                    if pieces is None:
                        rest[pre_token] = n
                    else:
                        total += n * pieces
                heads.append(total)
                rests.append(list(rest))
                numbers.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], batch["doc_id"], batch["n_bytes"], pa.array(heads, pa.int64()),
                    pa.array(rests, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "n_bytes", "head", "rest", "n"],
            )

    return run


def token_counts(
    docs: DataFrame,
    model: str | None = None,
    limit: int = LIMIT,
    head: int = HEAD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_tokens, over_limit).

    Counts are those of the library's ``encode``. A null text is empty and has no tokens. Null and
    repeated doc_ids are counted row by row, other columns are ignored, an empty table gives no rows.
    Texts are never cut: a very long one is a longer list of frequencies, and a very long pre-token
    is a key like any other.
    """
    spark = docs.sparkSession
    ship(spark)
    model = model or default_model()
    rows = id_and_text(docs, id_col, text_col)
    met = rows.select("text").mapInArrow(_distinct(model), "pre_token string, docs long")
    distinct = met.groupBy("pre_token").agg(F.sum("docs").alias("docs"))
    vocabulary = stored(distinct.mapInArrow(_count_once(model), "pre_token string, docs long, pieces long"), "pre_tokens")
    short = vocabulary.filter(F.octet_length("pre_token") <= HEAD_BYTES)
    top = short.orderBy(F.desc("docs"), "pre_token").limit(head).select("pre_token", "pieces").toArrow()
    common = dict(zip(top["pre_token"].to_pylist(), top["pieces"].to_pylist()))
    shared = spark.sparkContext.broadcast(common)
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    frequencies = stored(keyed.mapInArrow(_frequencies(model, shared), _FREQUENCIES), "frequencies")
    rest = frequencies.select("row", F.inline(F.arrays_zip(F.col("rest").alias("pre_token"), "n")))
    others = rest.join(vocabulary.select("pre_token", "pieces"), "pre_token").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
    n_tokens = F.col("head") + F.coalesce(others["rest"], F.lit(0))
    return (
        frequencies.select("row", "doc_id", "n_bytes", "head")
        .join(others, "row", "left")
        .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
    )


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
