"""Byte-level BPE of whole texts by overlapping chunks, and decoding to raw bytes."""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, ship, stored

CHUNK = 32_768  # characters from one chunk's start to the next
OVERLAP = 2_048  # characters that a chunk reads beyond that
KEEP = 800_000  # pieces that a worker remembers: some 200 bytes each


def default_ranks() -> tuple[str, str]:
    """(rank file, pattern that cuts text into pieces)"""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class PieceIds(dict):
    """piece of text -> its ids as unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}.__getitem__
        # white space as Unicode has it, also where Python counts a few control characters in
        own = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(own, regex.VERSION1)

    def __missing__(self, piece: str) -> bytes:
        found = array("I", self.encoding.encode_ordinary(piece)).tobytes()
        self[piece] = found
        return found

    def encode(self, pieces: list[str]) -> bytes:
        if len(self) > KEEP:
            self.clear()
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of, array("I", ids)))

    def starts(self, text: str) -> list[int]:
        """Where pieces begin."""
        return [match.start() for match in self.pattern.finditer(text)]

    def pieces(self, text: str, start: int, stop: int | None) -> list[str]:
        """The pieces from one boundary to another; the text beyond ``stop`` decides where they end."""
        if stop is None:
            return self.pattern.findall(text, start)
        found = []
        for match in self.pattern.finditer(text, start):
            if match.start() >= stop:
                break
            found.append(match.group())
        return found


@functools.lru_cache(maxsize=1)
def piece_ids(path: str, pattern: str) -> PieceIds:
    """One per worker."""
    return PieceIds(path, pattern)


def _arrow(function: Callable, ranks: tuple[str, str], types: list[pa.DataType], names: list[str]) -> Callable:
    """A function for mapInArrow that turns each row into some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_ids(*ranks)
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            rows = [out for row in zip(*columns) for out in function(coder, *row)]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _digest(coder: PieceIds, doc_id: int | None, ids: bytes) -> tuple:
    own = hashlib.sha256(ids).hexdigest()
    return doc_id, len(ids) // 4, own, hashlib.sha256(coder.decode(ids)).hexdigest()


_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_RESULT_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
_RESULT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string()]


def _whole(coder: PieceIds, doc_id: int | None, text: str) -> Iterator[tuple]:
    yield _digest(coder, doc_id, coder.encode(coder.pieces(text, 0, None)))


def _cut(coder: PieceIds, row: int, doc_id: int | None, text: str) -> Iterator[tuple]:
    for chunk, start in enumerate(range(0, len(text), CHUNK)):
        yield row, doc_id, chunk, text[start : start + CHUNK + OVERLAP], start + CHUNK >= len(text)


def _zones(coder: PieceIds, row: int, doc_id: int | None, chunk: int, text: str, last: bool) -> Iterator[tuple]:
    """Boundaries, as places in the document, in the overlaps with the chunks before and after."""
    starts = coder.starts(text)
    base = chunk * CHUNK
    head = [base + s for s in starts if s < OVERLAP] if chunk else []
    tail = [] if last else [base + s for s in starts if s >= CHUNK]
    yield row, doc_id, chunk, text, last, head, tail


def _encode_part(coder: PieceIds, row: int, doc_id: int | None, chunk: int, text: str, start: int | None, stop: int | None) -> Iterator[tuple]:
    base = chunk * CHUNK
    pieces = coder.pieces(text, (start or base) - base, None if stop is None else stop - base)
    yield row, doc_id, chunk, coder.encode(pieces)


def _join_parts(coder: PieceIds, doc_id: int | None, parts: list[dict]) -> Iterator[tuple]:
    yield _digest(coder, doc_id, b"".join(part["ids"] for part in parts))


def _long(rows: DataFrame, ranks: tuple[str, str]) -> DataFrame:
    """Texts of more than one chunk: chunks are spread over all tasks whatever text they are of.

    Matching looks ahead only, so two chunks that agree on one boundary agree from there on. The
    first boundary that a chunk shares with the overlap of the one before is where it takes over.
    A text in which some pair of chunks shares none (one piece longer than the overlap) is encoded
    in one go.
    """
    zone_types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    zone_names = ["row", "doc_id", "chunk", "text", "last", "head", "tail"]
    chunks = rows.mapInArrow(
        _arrow(_cut, ranks, zone_types[:5], zone_names[:5]), "row long, doc_id long, chunk int, text string, last boolean"
    ).repartition("row", "chunk")
    zones = stored(
        chunks.mapInArrow(
            _arrow(_zones, ranks, zone_types, zone_names),
            "row long, doc_id long, chunk int, text string, last boolean, head array<long>, tail array<long>",
        ),
        "bpe_chunks",
    )
    tails = zones.select("row", (F.col("chunk") + 1).alias("chunk"), "tail")
    starts = (
        zones.filter("chunk > 0")
        .select("row", "chunk", "head")
        .join(tails, ["row", "chunk"])
        .select("row", "chunk", F.array_min(F.array_intersect("head", "tail")).alias("start"))
    )
    starts = stored(starts, "bpe_starts")
    lost = starts.groupBy("row").agg(F.max(F.col("start").isNull()).alias("lost")).filter("lost").select("row")
    stops = starts.select("row", (F.col("chunk") - 1).alias("chunk"), F.col("start").alias("stop"))
    parts = (
        zones.join(lost, "row", "left_anti")
        .join(starts, ["row", "chunk"], "left")
        .join(stops, ["row", "chunk"], "left")
        .select("row", "doc_id", "chunk", "text", "start", "stop")
        .mapInArrow(
            _arrow(_encode_part, ranks, [pa.int64(), pa.int64(), pa.int32(), pa.binary()], ["row", "doc_id", "chunk", "ids"]),
            "row long, doc_id long, chunk int, ids binary",
        )
    )
    texts = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts")
    )
    joined = texts.select("doc_id", "parts").mapInArrow(_arrow(_join_parts, ranks, _RESULT_TYPES, _RESULT_NAMES), _RESULT)
    # a chunk's first CHUNK characters are its own, the rest are those of the next
    own = F.struct("chunk", F.left("text", F.lit(CHUNK)).alias("text"))
    rest = (
        zones.join(lost, "row", "left_semi")
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(own)).alias("parts"))
        .select("doc_id", F.array_join("parts.text", "").alias("text"))
    )
    return joined.unionByName(rest.mapInArrow(_arrow(_whole, ranks, _RESULT_TYPES, _RESULT_NAMES), _RESULT))


def byte_bpe(docs: DataFrame, ranks: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Texts of one chunk are encoded where they are read; longer ones chunk by chunk. A null or empty
    text has no ids. Null and repeated doc_ids are encoded row by row; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    ranks = ranks or default_ranks()
    rows = id_and_text(docs, id_col, text_col)
    short = rows.filter(F.length("text") <= CHUNK).mapInArrow(
        _arrow(_whole, ranks, _RESULT_TYPES, _RESULT_NAMES), _RESULT
    )
    long = rows.filter(F.length("text") > CHUNK).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return short.unionByName(_long(long, ranks))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(documents(spark, sf_dir))
