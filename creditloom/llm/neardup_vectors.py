"""Near-equal vectors by counting collisions of one-dimensional projections.

Every table projects a vector on one random line and sorts the vectors along it; two vectors collide
where they lie within a window centred on one of them.  Far vectors collide on a line often enough
to make all lines together quadratic, so a table sorts only inside a cell: the signs of further
random projections, more of them for more vectors.  Pairs are counted over the tables, and those
with enough collisions are compared exactly.

The number of tables and the least count follow from the wanted recall of a pair exactly at the
threshold; closer pairs are found more surely.  Equal vectors of a label are one vector with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components

SEED = 20240
WINDOW_SIGMAS = 1.6
RECALL = 0.999
LEAST_COUNT = 2


def usable(column: str) -> Column:
    """True for a vector that has a direction: no NULL, NaN or infinite part, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def calibrated(cosine: float, rows: int, recall: float = RECALL) -> dict:
    """Signs per cell, window half-width, tables and least count for a recall at the threshold."""
    signs = max(0, math.ceil(math.log2(max(rows, 1) / 32)))
    spread = math.sqrt(2 - 2 * cosine)
    window = WINDOW_SIGMAS * spread
    hit = (1 - math.acos(cosine) / math.pi) ** signs * math.erf(WINDOW_SIGMAS / math.sqrt(2))
    tables = LEAST_COUNT
    while sum(math.comb(tables, i) * hit**i * (1 - hit) ** (tables - i) for i in range(LEAST_COUNT)) > 1 - recall:
        tables += 1
    return {"signs": signs, "window": window, "tables": tables, "least": LEAST_COUNT}


def projected(reps: DataFrame, plan: dict) -> DataFrame:
    """(rep, grp, tab, cell, strip, at): a row per vector and table.  Strips are one window wide."""
    signs, tables, window = plan["signs"], plan["tables"], plan["window"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch.column("vec")))
            for dim in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == dim))
                if dim not in lines:
                    lines[dim] = np.random.default_rng([SEED, dim]).standard_normal((tables * (signs + 1), dim))
                x = np.asarray(own.column("vec").flatten(), dtype=np.float64).reshape(-1, dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                y = (x @ lines[dim].T).reshape(len(x), tables, signs + 1)
                cell = ((y[:, :, 1:] > 0) * (1 << np.arange(signs, dtype=np.int64))).sum(axis=2)
                at = y[:, :, 0]
                yield pa.RecordBatch.from_pydict(
                    {
                        "rep": pa.array(np.repeat(np.asarray(own.column("rep")), tables), pa.int64()),
                        "grp": pa.array(np.repeat(np.asarray(own.column("grp")), tables), pa.int64()),
                        "tab": pa.array(np.tile(np.arange(tables, dtype=np.int32), len(x))),
                        "cell": pa.array(cell.ravel().astype(np.int64)),
                        "strip": pa.array(np.floor(at / window).astype(np.int32).ravel()),
                        "at": pa.array(at.ravel()),
                    }
                )

    kinds = "rep long, grp long, tab int, cell long, strip int, at double"
    return reps.select("rep", "grp", "vec").mapInArrow(project, kinds)


def collision_counts(rows: DataFrame, plan: dict) -> DataFrame:
    """(a, b, hits) for pairs a < b that lie within the window in at least one table.

    A window reaches into its own strip and the next ones only, so it is an equality join.
    """
    there = rows.select(
        F.col("rep").alias("other"), "grp", "tab", "cell", F.col("at").alias("other_at"),
        F.explode(F.array(F.col("strip"), F.col("strip") - 1)).alias("strip"), F.col("strip").alias("other_strip"),
    )
    # Within a strip a pair meets twice: keep one order.  Across strips it meets once.
    once = (F.col("strip") < F.col("other_strip")) | (F.col("rep") < F.col("other"))
    return (
        rows.join(there, ["grp", "tab", "cell", "strip"])
        .where((F.abs(F.col("at") - F.col("other_at")) <= plan["window"]) & once)
        .groupBy(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def verified(pairs: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """(a, b, cosine) of the pairs at or above the threshold, in double precision."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, values = [], []
            sizes = np.asarray(pc.list_value_length(batch.column("va")))
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                own = batch.take(pa.array(rows))
                x, y = (np.asarray(own.column(c).flatten(), dtype=np.float64).reshape(-1, dim) for c in ("va", "vb"))
                x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
                cos = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                good = cos >= cosine
                keep.append(rows[good])
                values.append(cos[good])
            rows = np.concatenate(keep) if keep else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(rows)), batch.column("b").take(pa.array(rows)), pa.array(np.concatenate(values) if values else [], pa.float64())],
                names=["a", "b", "cosine"],
            )

    vectors = reps.select("rep", "vec")
    joined = (
        pairs.join(vectors.select(F.col("rep").alias("a"), F.col("vec").alias("va")), "a")
        .join(vectors.select(F.col("rep").alias("b"), F.col("vec").alias("vb")), "b")
        .select("a", "b", "va", "vb")
    )
    return joined.mapInArrow(compare, "a long, b long, cosine double")


def link_vectors(vectors: DataFrame, cosine: float = 0.93, recall: float = RECALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, members, links): equal vectors, whose they are, and the linked class pairs.

    Only vectors of one label and one length are compared; a NULL label, a NULL id or a vector
    without a direction takes no part.
    """
    valid = vectors.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.xxhash64(F.col("label").cast("string"), F.size("embedding")).alias("grp"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )
    alike = valid.groupBy("grp", "vec")
    classes = staged(alike.agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vec-classes")
    members = valid.join(classes, ["grp", "vec"]).select("vec_id", "rep", "n")
    largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    plan = calibrated(cosine, largest, recall)
    counts = collision_counts(staged(projected(classes, plan), "vec-tables"), plan)
    links = staged(verified(counts.where(F.col("hits") >= plan["least"]), classes, cosine), "vec-links")
    return classes, staged(members, "vec-members"), links


def near_duplicates(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every input row.

    Rows that take no part have no links and are their own component (a NULL id: not kept).
    """
    classes, members, links = link_vectors(vectors, cosine)
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    parts = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    found = (
        members.join(others, F.col("rep") == F.col("a"), "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .groupBy("vec_id")  # an id that occurs twice takes its larger count
        .agg(
            F.max(F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("__links"),
            F.min(F.coalesce("component", "rep")).alias("__component"),
        )
        .withColumnRenamed("vec_id", "__id")
    )
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    component = F.coalesce("__component", "vec_id")
    return ids.join(found, F.col("vec_id") == F.col("__id"), "left").select(
        "vec_id",
        F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
