"""Shards of near-equal bytes by a k-d tree over document metadata.

Every node is split at its weighted median along its widest metadata dimension until a leaf reaches
the target bytes.  A split orders the documents by (dimension, hash) packed into 62 bits and finds the
median by narrowing bit ranges: each step sums bytes per (node, 10 bits), at most 1024 rows per
node, and only the range that holds the median is looked at further.  No row is moved or sorted
for a split, and one value that holds a third of all rows is split by its hash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered_within, staged, utf8_bytes

DIMENSIONS = ("size", "lang", "source", "text_crc32")
STEP_BITS, DIM_BITS, HASH_BITS = 10, 20, 40


def metadata(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, tie and one number from 0 to 1 per dimension).

    Sizes count on a log scale; lang and source are spread by their hash; NULL is a value of its
    own.  Size is the UTF-8 bytes of the text (none for NULL) plus 1.
    """
    body = utf8_bytes("text")

    def spread(column: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(column.cast("string"), F.lit("\0null"))), F.lit(1 << 20)) / (1 << 20)

    size = (F.octet_length(body) + 1).cast("long")
    crc = F.crc32(body)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.least(F.log2(size) / 40, F.lit(1.0)).alias("dim_size"),
        spread(F.col("lang")).alias("dim_lang"),
        spread(F.col("source")).alias("dim_source"),
        (crc / float(1 << 32)).alias("dim_text_crc32"),
        F.pmod(F.xxhash64("doc_id", crc, size), F.lit(1 << HASH_BITS)).alias("tie"),
    )


def _per_node(values: dict[int, object], kind: str) -> Column:
    """A lookup by node.  Nodes are shards (tens), so this is a small literal map."""
    pairs = [F.lit(x).cast(t) for k, v in values.items() for x, t in ((k, "int"), (v, kind))]
    return F.create_map(*pairs)[F.col("node")]


def split_points(nodes: DataFrame, widest: dict[int, str], goals: dict[int, float]) -> dict[int, int]:
    """For each node the first order value that belongs to its upper half."""
    total_bits = DIM_BITS + HASH_BITS
    low = {n: 0 for n in widest}
    before = {n: 0 for n in widest}
    shift = total_bits
    while shift > 0:
        width = min(STEP_BITS, shift)
        upper, shift = shift, shift - width
        inside = nodes.where(F.col("node").isin(list(widest))).where(
            F.shiftrightunsigned("rank", upper) == F.shiftrightunsigned(_per_node(low, "long"), upper)
        )
        sums = inside.groupBy("node", F.shiftrightunsigned("rank", shift).alias("cell")).agg(F.sum("size").alias("bytes")).collect()
        cells: dict[int, list] = {n: [] for n in widest}
        for r in sums:
            cells[r["node"]].append((r["cell"], r["bytes"]))
        for n, found in cells.items():
            for cell, size in sorted(found):
                low[n] = cell << shift
                if before[n] + size > goals[n]:
                    break
                before[n] += size
            else:
                low[n] = ((max(found)[0] if found else 0) + 1) << shift
    return low


def kd_leaves(meta: DataFrame, shards: int) -> DataFrame:
    """Add ``node``: the leaf, from 0 to ``shards`` - 1.  Leaves hold near-equal bytes.

    A node that is to hold k leaves sends the bytes of floor(k / 2) of them to its lower half.
    """
    dims = [c for c in meta.columns if c.startswith("dim_")]
    nodes = meta.withColumn("node", F.lit(0))
    leaves = {0: shards}
    while any(k > 1 for k in leaves.values()):
        shape = nodes.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *[F.stddev_pop(d).alias(d) for d in dims],
        ).collect()
        open_nodes = {r["node"]: r for r in shape if leaves[r["node"]] > 1}
        if not open_nodes:
            break
        widest = {n: max(dims, key=lambda d: (r[d] or 0.0, d)) for n, r in open_nodes.items()}
        goals = {n: r["bytes"] * (leaves[n] // 2) / leaves[n] for n, r in open_nodes.items()}
        chosen = reduce(
            lambda c, d: c.when(_per_node({n: w == d for n, w in widest.items()} , "boolean"), F.col(d)),
            dims, F.when(F.lit(False), F.lit(0.0)),
        )
        top = F.least(F.floor(chosen * (1 << DIM_BITS)), F.lit((1 << DIM_BITS) - 1)).cast("long")
        # Written once per level: every narrowing step reads the order values, none derives them again.
        ranked = staged(nodes.withColumn("rank", F.shiftleft(top, HASH_BITS) + F.col("tie")), "kd-level")
        cuts = split_points(ranked, widest, goals)
        upper = F.col("rank") >= _per_node(cuts, "long")
        # A node's lower half keeps its number; the upper half starts after the lower one's leaves.
        moved = F.col("node") + _per_node({n: leaves[n] // 2 for n in widest}, "int")
        nodes = ranked.withColumn("node", F.when(upper, moved).otherwise(F.col("node"))).drop("rank")
        halves = {}
        for n, k in leaves.items():
            if n in widest:
                halves |= {n: k // 2, n + k // 2: k - k // 2}
            else:
                halves[n] = k
        leaves = halves
    return nodes


def shard_by_bytes(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document.

    Give the number of shards or the bytes a leaf should reach.  ``slot`` is gapless from 0 in each
    shard.  Null and repeated ids are kept; rows equal in id, text and size are
    interchangeable.  Further columns are ignored; an empty table gives an empty result.
    """
    meta = staged(metadata(docs), "kd")
    if shards is None:
        total = meta.agg(F.sum("size")).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    leaves = staged(kd_leaves(meta, shards).select("doc_id", "size", "text_crc32", F.col("node").alias("shard")), "kd-leaves")
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return numbered_within(leaves, [F.col("shard")], order, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
