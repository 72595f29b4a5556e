"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of documents; a last short block is a block.  In the fluid schedule
each source that has blocks left receives its weight's share of every moment, so block j (from 1) of
a source with weight w (of a sum of 1) runs from (j - 1) / w to j / w until a source runs dry, from
when on the others share its part.  A block may start at the slot that holds its fluid start and
must end by the slot that holds its fluid end; of the released blocks, the one with the earliest
deadline takes the next slot.  At every slot each source has then received its fluid share with less
than one block of deviation.

Windows are computed in whole numbers from the exact weights.  The schedule is one pass over the blocks on the driver, which holds
one entry per source and one slice of the schedule; documents find their slot by a join on (source, block).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import scratch_path
from .common import numbered_within, staged

BLOCK_DOCS = 8
SLICE_SLOTS = 500_000


def whole_parts(weights: dict[str | None, float], cycle: int) -> dict[str | None, int]:
    """Weights as whole parts of ``cycle`` slots, by largest remainder, one part at least each."""
    positive = {s: Fraction(w) for s, w in weights.items() if w and w > 0}
    if not positive:
        return {}
    cycle = max(cycle, len(positive))
    total = sum(positive.values())
    spare = cycle - len(positive)
    exact = {s: w / total * spare for s, w in positive.items()}
    parts = {s: 1 + int(x) for s, x in exact.items()}
    by_remainder = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is None, s or ""))
    for s in by_remainder[: cycle - sum(parts.values())]:
        parts[s] += 1
    return parts


def fluid_windows(whole: list[int], blocks: list[int]):
    """A function (source, block from 0) -> (release slot, deadline) of the fluid schedule.

    A source with weight w and b blocks is dry when each unit of weight has received b / w; between
    two such marks the slots used up grow by the sum of the weights not dry yet.
    """
    order = sorted(range(len(whole)), key=lambda k: Fraction(blocks[k], whole[k]))
    done, active, marks = 0, sum(whole), []
    for k in order:
        marks.append((blocks[k], whole[k], done, active))
        done, active = done + blocks[k], active - whole[k]

    def slots(j: int, w: int) -> tuple[int, int]:
        """(before, parts of 1 / w) of the slots used up when each unit of weight has received j / w."""
        low, high = 0, len(marks) - 1
        while low < high:
            middle = (low + high) // 2
            if j * marks[middle][1] <= marks[middle][0] * w:
                high = middle
            else:
                low = middle + 1
        return marks[low][2], marks[low][3] * j

    def window(k: int, j: int) -> tuple[int, int]:
        first, start = slots(j, whole[k])
        last, end = slots(j + 1, whole[k])
        return first + start // whole[k], last - (-end // whole[k])

    return window


def pfair_schedule(
    weights: dict[str | None, float], counts: dict[str | None, int], block_docs: int = BLOCK_DOCS, hold: bool = False
) -> Iterator[tuple[str | None, int, int, int | None]]:
    """(source, block, slot, position of its first document) of all blocks, in order of the slots.

    With ``hold`` the positions end before the first slot whose source has no full block left.
    """
    exact = {s: Fraction(w) for s, w in weights.items() if w and w > 0 and (counts.get(s) or hold)}
    names = sorted(exact, key=lambda s: (s is None, s or ""))
    scale = math.lcm(*[w.denominator for w in exact.values()])
    have = [counts.get(s, 0) for s in names]
    blocks = [n // block_docs + 1 if hold else -(-n // block_docs) for n in have]
    window = fluid_windows([int(exact[s] * scale) for s in names], blocks)
    waiting, ready = [], []
    for k in range(len(names)):
        release, deadline = window(k, 0)
        waiting.append((release, deadline, k, 0))
    heapq.heapify(waiting)
    position = 0
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        _, k, j = heapq.heappop(ready)
        size = min(block_docs, have[k] - j * block_docs)
        if hold and size < block_docs:
            position = None
        yield names[k], j, slot, position
        if position is not None:
            position += size
        if j + 1 < blocks[k]:
            release, deadline = window(k, j + 1)
            heapq.heappush(waiting, (release, deadline, k, j + 1))


def stored_schedule(spark: SparkSession, rows: Iterator[tuple]) -> DataFrame:
    """The schedule as a table; one that is longer than a slice goes to the shared folder slice by slice."""
    kinds = pa.schema([("__source", pa.string()), ("__block", pa.int64()), ("__slot", pa.int64()), ("__start", pa.int64())])
    path = None
    while True:
        part = list(islice(rows, SLICE_SLOTS))
        columns = [pa.array([r[i] for r in part], kind.type) for i, kind in enumerate(kinds)]
        df = spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds))
        if path is None and len(part) < SLICE_SLOTS:
            return df
        path = path or scratch_path(spark, "mix-schedule")
        df.write.mode("append").parquet(path)
        if len(part) < SLICE_SLOTS:
            return spark.read.schema(df.schema).parquet(path)


def tempered_weights(docs: DataFrame, alpha: float = 0.9) -> dict[str | None, float]:
    """Target weights: document counts to the power ``alpha``, which lifts small sources.

    One row per source comes to the driver.
    """
    return {r["source"]: r["count"] ** alpha for r in docs.groupBy("source").count().collect()}


def mix(
    docs: DataFrame,
    weights: dict[str | None, float],
    order: list[Column],
    block_docs: int = BLOCK_DOCS,
    cycle: int | None = None,
) -> DataFrame:
    """Add ``block`` (of the source), ``slot`` and ``position`` (gapless from 0) to the documents.

    Every document of a source with a weight gets a position: when a source runs dry, the others go
    on with their weights.  Documents of sources without a weight stay in the result with a NULL
    ``slot`` and ``position``.  With ``cycle`` the weights are whole parts of so many slots, and
    positions end before the first slot whose source has no full block left; later documents have a
    NULL position.  A NULL source is a source.  ``order`` fixes the order within a source (for stable
    results it should be unique).  Columns of ``docs`` named source are needed; others are kept, but
    block, slot and position are replaced.
    """
    own = [c for c in docs.columns if c not in ("block", "slot", "position")]
    if "source" not in own:
        raise ValueError("documents need a source column")
    hold = cycle is not None
    counts = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    shares = whole_parts(weights, cycle) if hold else weights
    schedule = stored_schedule(docs.sparkSession, pfair_schedule(shares, counts, block_docs, hold))
    placed = numbered_within(docs.select(*own), [F.col("source")], order, "__row").withColumn(
        "block", F.floor(F.col("__row") / block_docs)
    )
    same = (F.col("block") == F.col("__block")) & F.col("source").eqNullSafe(F.col("__source"))
    return placed.join(schedule, same, "left").select(
        *own, "block", F.col("__slot").alias("slot"), (F.col("__start") + F.col("__row") % block_docs).alias("position")
    )


def mix_documents(docs: DataFrame, alpha: float = 0.9) -> DataFrame:
    """The mix of a document table by tempered weights, in order of doc_id within a source."""
    narrow = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")),
        "mix",
    )
    return mix(narrow, tempered_weights(narrow, alpha), [F.col("doc_id"), F.col("text_crc32")])
