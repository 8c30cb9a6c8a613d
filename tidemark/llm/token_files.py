"""Token ids as binary files of independently coded blocks, in ascending order of doc_id.

A file is a sequence of groups. A group holds whole documents: a header, a directory, blocks, a line
feed. Numbers are little-endian.

    header     4 bytes "TID1", documents u32, blocks u32, ids u64, crc32 of the directory u32
    directory  per document doc_id i64, then per document 1 if it has none u8, then ids u32
    block      ids u32, bytes of code u32, crc32 of the code and then the ids u32, code (see id_coder)
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, new_folder, ship
from .id_coder import BLOCK, decode, encode
from .packing import default_vocabulary
from .word_ids import as_array, word_ids

MAGIC = b"TID1"
HEADER, ENTRY = struct.Struct("<4sIIQI"), struct.Struct("<III")
GROUP_IDS = 1536 * BLOCK  # ids from which on a group is closed; coding takes some 45 bytes for each
GROUPS_PER_FILE = 8


def write_group(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One group from documents' ids that lie end to end."""
    lanes = -(-ids.size // BLOCK)
    steps = min(BLOCK, ids.size)
    rows = np.zeros(lanes * steps, np.int32)
    rows[: ids.size] = ids
    rows[ids.size :] = ids[-1]  # fills the last block; not part of the group's ids
    directory = b"".join(
        (
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array(counts, "<u4").tobytes(),
        )
    )
    parts = [HEADER.pack(MAGIC, len(doc_ids), lanes, ids.size, zlib.crc32(directory)), directory]
    for i, code in enumerate(encode(rows.reshape(lanes, steps))):
        own = ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4")
        parts += [ENTRY.pack(own.size, len(code), zlib.crc32(own, zlib.crc32(code))), code]
    return b"".join(parts)


def read_groups(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, counts, ids) of each group; raises ValueError where a checksum does not hold."""
    at = 0
    while at < len(content):
        magic, n_docs, n_blocks, n_ids, check = HEADER.unpack_from(content, at)
        at += HEADER.size
        directory = content[at : at + 13 * n_docs]
        if magic != MAGIC or zlib.crc32(directory) != check:
            raise ValueError("damaged directory")
        at += len(directory)
        none = np.frombuffer(directory, np.uint8, n_docs, 8 * n_docs)
        doc_ids = [None if gone else d for d, gone in zip(np.frombuffer(directory, "<i8", n_docs).tolist(), none)]
        counts = np.frombuffer(directory, "<u4", n_docs, 9 * n_docs)
        sizes, codes, checks = [], [], []
        for _ in range(n_blocks):
            size, length, check = ENTRY.unpack_from(content, at)
            at += ENTRY.size
            sizes.append(size)
            codes.append(content[at : at + length])
            checks.append(check)
            at += length
        rows = decode(codes, min(BLOCK, n_ids)).astype("<u4")
        for row, size, code, check in zip(rows, sizes, codes, checks):
            if zlib.crc32(row[:size].tobytes(), zlib.crc32(code)) != check:
                raise ValueError("damaged block")
        at += 1  # the line feed
        yield doc_ids, counts, rows.ravel()[:n_ids]


def _groups(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            value = write_group(doc_ids, [len(own) // 2 for own in parts], as_array(parts))
            return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], names=["value"])

        ids = word_ids(path)
        doc_ids, parts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                parts.append(ids.of(text))
                doc_ids.append(doc_id)
                size += len(parts[-1]) // 2
                if size >= GROUP_IDS:
                    yield close()
                    doc_ids, parts, size = [], [], 0
        if parts:
            yield close()

    return run


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, a null one as empty, each followed by the end id, into files of ``folder``.

    Files sorted by name, and groups in them, hold ascending doc_ids, those without one first; rows of
    one doc_id are ordered by a hash of their texts, so that they can be split between files too. An
    empty table gives files without a group. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    groups = dealt.mapInArrow(_groups(vocabulary or default_vocabulary()), "value binary")
    # the text writer copies the bytes of a value as they are and ends it with a line feed
    groups.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", GROUPS_PER_FILE).text(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
            start = 0
            for doc_ids, counts, ids in read_groups(content):
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(doc_ids)), pa.array(doc_ids, pa.int64()), pa.array(starts + start),
                        pa.array(counts.astype(np.int64)), pa.array(crcs, pa.int64()),
                    ],
                    names=["path", "doc_id", "start", "n_tokens", "ids_crc32"],
                )
                start += int(ends[-1])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: (doc_id, start, n_tokens, ids_crc32), from the ids in the files.

    One number per file comes to the driver, to say how many ids lie before it.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("path", "content")
    path = new_folder(spark, "token_rows")
    files.mapInArrow(_read, "path string, doc_id long, start long, n_tokens long, ids_crc32 long").write.parquet(path)
    rows = spark.read.parquet(path)
    before, total = [], 0
    for r in rows.groupBy("path").agg(F.sum("n_tokens").alias("n")).orderBy("path").collect():
        before.append((r["path"], total))
        total += r["n"]
    # as an Arrow table it is made without Python workers
    paths, counts = (pa.array([row[i] for row in before], kind) for i, kind in enumerate((pa.string(), pa.int64())))
    offsets = spark.createDataFrame(pa.table({"path": paths, "before": counts}))
    return rows.join(F.broadcast(offsets), "path").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = new_folder(spark, "token_ids")
    write_token_files(docs, folder)
    return read_token_files(spark, folder)
