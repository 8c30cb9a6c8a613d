"""Merkle manifest of a table: a root over all rows, and for each row the proof that leads there.

Rows are leaves. Per source they ascend by doc_id; runs of FANOUT nodes become one node until one is
left, and the sources' subroots, ordered by source, become the root likewise.

1. Leaves get their place in their source by range partitioning; no source is ever in one task.
2. FANOUT ** LOCAL consecutive leaves are a block, which hashes its own subtree.
3. Butterfly exchange between the blocks: in round r, aligned groups of FANOUT subtrees swap their
   roots. Lanes pair the blocks: lane x of a group holds one block of each subtree, so a block hears
   of the other subtrees' roots from at most FANOUT - 1 partners, and no group is larger than FANOUT
   rows. Each block hashes the ancestor itself, as its partners do, and keeps what it heard: after the
   last round every block holds its whole upper proof, and nothing is passed down. A subtree with
   fewer blocks than the group has lanes sends its root to several lanes.
4. The rounds go on over the sources in the same way, a source's blocks being its lanes.
5. Each block writes the proofs of its leaves, and folds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, ship, stored

FANOUT = 3
LOCAL = 6  # levels that a block hashes by itself: 729 leaves
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

_H = hashlib.sha256


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def _placed(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in each group ``by``, and ``size``, the rows of the group.

    Rows are partitioned by ranges of ``by`` and ``order`` and counted by partition; a group's share
    in a partition begins where its shares in earlier partitions end. So the windows run over one row
    per group and partition, not over the rows. Rows equal in all columns may change places.
    """
    order = [*by, *order]
    kept = rows.withColumn("__at", F.monotonically_increasing_id())
    spread = kept.repartitionByRange(*order, "__at").sortWithinPartitions(*order, "__at")
    # upper bits: the partition, lower ones: the row's place in it
    ranged = stored(spread.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    keys = ["__part", *by]
    shares = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.sum("__n").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    shares = shares.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(group).alias("size"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return ranged.join(shares, same).select(
        *rows.columns, (F.col("__at") + F.col("__shift")).alias("place"), "size"
    )


def levels(nodes: int, fanout: int) -> int:
    """How many levels lie above so many nodes, until one is left."""
    found = 0
    while nodes > 1:
        nodes = -(-nodes // fanout)
        found += 1
    return found


def _hash_up(nodes: list[str], rounds: int, fanout: int) -> list[list[str]]:
    """The nodes of each level, from the given ones on."""
    found = [nodes]
    for _ in range(rounds):
        last = found[-1]
        found.append([_H("".join(last[i : i + fanout]).encode()).hexdigest() for i in range(0, len(last), fanout)])
    return found


def _subroots(fanout: int, local: int) -> Callable:
    """Blocks with their own roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [
                _hash_up([leaf["leaf"] for leaf in leaves], min(local, levels(size, fanout)), fanout)[-1][0]
                for size, leaves in zip(batch["size"].to_pylist(), batch["leaves"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], names=[*batch.schema.names, "digest"])

    return run


def _round(state: DataFrame, fanout: int) -> DataFrame:
    """One exchange. ``state`` has a row per block: ``tree``, ``node`` (its subtree's index in this
    level), ``slot`` (the block's index in the subtree), ``m`` (the subtree's blocks) and ``lanes``
    (the blocks of the group's largest subtree); digest and steps are carried on."""
    own = ["s", "block", "slot", "steps", "more"]
    messages = state.withColumn("lane", F.explode(F.sequence("slot", F.col("lanes") - 1, "m")))
    real = F.when(F.col("lane") == F.col("slot"), F.struct(*own))
    at = F.pmod("node", F.lit(fanout))
    groups = messages.groupBy("tree", F.floor(F.col("node") / fanout).alias("up"), "lane").agg(
        F.array_sort(F.collect_list(F.struct(at.alias("at"), "digest", "m", real.alias("own")))).alias("run")
    )
    parent = F.sha2(F.array_join("run.digest", ""), 256)
    blocks = F.aggregate("run.m", F.lit(0).cast("long"), lambda total, m: total + m)
    heard = groups.select("tree", F.col("up").alias("node"), parent.alias("digest"), blocks.alias("m"), "run", F.posexplode("run").alias("i", "one"))
    before = F.aggregate(F.slice("run.m", 1, F.col("i")), F.lit(0).cast("long"), lambda total, m: total + m)
    step = F.struct(F.col("i").alias("at"), F.col("run.digest").alias("nodes"))
    return heard.filter("one.own IS NOT NULL").select(
        "tree", "node", "digest", "m", "one.own.s", "one.own.block", (before + F.col("one.own.slot")).alias("slot"),
        F.concat("one.own.steps", F.array(step)).alias("steps"), "one.own.more",
    )


def _within_sources(state: DataFrame, fanout: int) -> DataFrame:
    """Rounds until every block knows its source's subroot."""
    longest = state.agg(F.max("blocks")).first()[0] or 1
    done, width = None, 1  # width: the blocks of a full subtree
    while True:
        over = state.filter(F.col("blocks") <= width)
        done = over if done is None else done.unionByName(over)
        if longest <= width:
            return done
        first = F.floor(F.col("block") / (width * fanout)) * (width * fanout)
        node = F.floor(F.col("block") / width)
        going = state.filter(F.col("blocks") > width).select(
            F.col("s").alias("tree"), node.alias("node"), (F.col("block") - node * width).alias("slot"),
            F.least(F.lit(width), F.col("blocks") - node * width).alias("m"),
            F.least(F.lit(width), F.col("blocks") - first).alias("lanes"),
            "digest", "s", "block", "steps", F.struct("blocks", "sources").alias("more"),
        )
        state = stored(_round(going, fanout).select("s", "block", "more.*", "digest", "steps"), "butterfly")
        width *= fanout


def _over_sources(state: DataFrame, fanout: int) -> DataFrame:
    """Rounds over the sources' subroots until every block knows the root."""
    sources = state.agg(F.max("sources")).first()[0] or 0
    nodes = state.select(F.col("s").alias("node"), F.col("blocks").alias("m")).distinct()
    state = state.select(
        F.lit(0).alias("tree"), F.col("s").alias("node"), F.col("block").alias("slot"), F.col("blocks").alias("m"),
        "digest", "s", "block", "steps", F.struct(F.size("steps").alias("below"), F.col("digest").alias("subroot")).alias("more"),
    )
    while sources > 1:
        nodes = stored(nodes, "subtrees")
        up = F.floor(F.col("node") / fanout)
        groups = nodes.groupBy(up.alias("up")).agg(F.max("m").alias("lanes"), F.sum("m").alias("m"))
        going = state.join(groups.select("up", "lanes"), F.floor(state["node"] / fanout) == F.col("up")).drop("up")
        state = stored(_round(going, fanout), "butterfly")
        nodes, sources = groups.select(F.col("up").alias("node"), "m"), -(-sources // fanout)
    return state.select("s", "block", "more.subroot", F.col("digest").alias("root"), "steps")


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(fanout: int, local: int) -> Callable:
    """Blocks with their upper proofs to a row per leaf."""

    def of_block(size: int, leaves: list[dict], subroot: str, root: str, steps: list[dict]) -> Iterator[tuple]:
        own = _hash_up([leaf["leaf"] for leaf in leaves], min(local, levels(size, fanout)), fanout)
        upper = "".join(d for s in steps for i, d in enumerate(s["nodes"]) if i != s["at"])
        for place, leaf in enumerate(leaves):
            proof, digest, at = [], leaf["changed"], place
            for nodes in own[:-1]:
                run = nodes[at - at % fanout : at - at % fanout + fanout]
                proof += run[: at % fanout] + run[at % fanout + 1 :]
                run[at % fanout] = digest
                digest, at = _H("".join(run).encode()).hexdigest(), at // fanout
            for step in steps:
                run = [*step["nodes"]]
                run[step["at"]] = digest
                digest = _H("".join(run).encode()).hexdigest()
            whole = _H(("".join(proof) + upper).encode()).hexdigest()
            yield leaf["doc_id"], leaf["leaf"], subroot, root, whole, digest, digest == root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("size", "leaves", "subroot", "root", "steps")]
            rows = [row for block in zip(*columns) for row in of_block(*block)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)

    return run


def merkle_manifest(docs: DataFrame, changed: Column | None = None, fanout: int = FANOUT, local: int = LOCAL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other columns are ignored).

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. ``changed``: the text
    as it is found when proofs are checked (the given text if None); the root is recomputed from the
    leaf of that text and the proof, and is verified if it equals the root. Null values are fields of
    their own. A null doc_id comes first; rows that share source and doc_id are ordered by their
    leaves, and equal rows have equal leaves, so their proofs are those of their places in any order.
    A null source is a source, the first one. A source of one row is its own subroot, a single source
    its own root. Long texts are hashed where they are read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    whole = [docs[c] for c in FIELDS]
    leaf = leaf_of(whole)
    other = leaf if changed is None else leaf_of([*whole[:-1], changed])
    leaves = docs.select(docs["source"].cast("string").alias("source"), docs["doc_id"].cast("long").alias("doc_id"), leaf.alias("leaf"), other.alias("changed"))
    placed = _placed(leaves, ["source"], ["doc_id", "leaf"])
    per_block = fanout**local
    sources = _placed(leaves.select("source").distinct(), [], ["source"]).select(
        F.col("source").alias("_source"), F.col("place").alias("s"), F.col("size").alias("sources")
    )
    placed = placed.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    gathered = placed.groupBy("s", F.floor(F.col("place") / per_block).alias("block")).agg(
        F.first("size").alias("size"), F.first("sources").alias("sources"),
        F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "changed"))).alias("leaves"),
    )
    schema = f"{_ddl(gathered)}, digest string"
    blocks = stored(gathered.mapInArrow(_subroots(fanout, local), schema), "blocks")
    state = blocks.select(
        "s", "block", F.ceil(F.col("size") / per_block).alias("blocks"), "sources", "digest",
        F.array().cast("array<struct<at:int,nodes:array<string>>>").alias("steps"),
    )
    proofs = _over_sources(_within_sources(state, fanout), fanout)
    return blocks.drop("digest", "sources").join(proofs, ["s", "block"]).mapInArrow(_prove(fanout, local), _RESULT)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def without_line_ends(docs: DataFrame) -> Column:
    """The tampering that is tried: line ends go from the texts of every second document, by checksum."""
    picked = F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(2)) == 0
    return F.when(picked, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return merkle_manifest(docs, without_line_ends(docs))
