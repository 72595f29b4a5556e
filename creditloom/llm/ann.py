"""Approximate nearest neighbours by largest inner product over balanced posting lists.

Fit: balanced k-means on at most SAMPLE_ROWS rows gives the centroids (about the square root of the row
count, one per 8 sampled rows at most) and a neighbour graph of them, both small enough for every
task.  Index: every row finds its nearest centroids by a walk on the graph and is put on the list of
each one that is hardly farther than the nearest (boundary vectors stand on several lists).
Search: a query walks the same graph and opens the lists within a distance ratio of its nearest
centroid.  The ratio is the least that reaches nearly all true neighbours inside the sample, where
neighbours are farther than in the full table, so it errs on the safe side.

A query's FIRST_LISTS nearest lists are searched first; its k-th best score there is a lower bound, and the
further lists only hand out what reaches it.  So the rows that leave the lists stay a fixed number per
query, however many lists are opened, and no result is lost.

Inner products become distances by one more coordinate (the rest of the largest length).  Lists and
their queries are cut into parts by a hash, so a task holds a bounded piece of a list of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .neardup_vectors import usable

SAMPLE_ROWS = 20_000
SEED = 77
DEGREE = 24
BOUNDARY_RATIO = 1.15
REPLICAS = 4
REACHED = 0.96
BEAM = 12
LEAST_LISTS = 8
FIRST_LISTS = 8
LIST_PART_ROWS = 4_000
QUERY_PART_ROWS = 2_000
_WALK_ROWS = 1_024


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Stored vectors with the coordinate that makes the largest inner product the least distance."""
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def as_query(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0.0))


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """k-means whose assignment adds a penalty for lists above the mean size."""
    rng = np.random.default_rng(SEED)
    centroids = x[rng.choice(len(x), size=lists, replace=False)].copy()
    penalty = np.zeros(lists)
    for _ in range(rounds):
        cost = distances(x, centroids) + penalty[None, :]
        nearest = cost.argmin(axis=1)
        sizes = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        penalty = 0.05 * np.median(cost.min(axis=1)) * np.log1p(sizes * lists / len(x))
    return centroids


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The nearest others of every centroid, and a few random ones so that no part is cut off."""
    near = np.argsort(distances(centroids, centroids), axis=1)[:, 1 : degree + 1]
    far = np.random.default_rng(SEED).integers(0, len(centroids), (len(centroids), 4))
    return np.concatenate([near, far], axis=1)


def walk(
    x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, ratio: float, floor: float, beam: int | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, centroids, distances) within ``ratio`` of the nearest found (LEAST_LISTS at least), nearest first.

    The nearest counts as ``floor`` at least, so that a vector on top of a centroid opens others too.
    Best first for a batch of rows at once: each step opens every row's nearest unopened centroid
    and ends for a row when that one is outside the ratio or behind the best ``beam`` found.
    """
    for start in range(0, len(x), _WALK_ROWS):
        own = x[start : start + _WALK_ROWS]
        seen = np.full((len(own), len(centroids)), np.inf)
        opened = np.zeros(seen.shape, dtype=bool)
        entry = np.linspace(0, len(centroids) - 1, min(8, len(centroids))).astype(int)
        seen[:, entry] = distances(own, centroids[entry])
        least = min(LEAST_LISTS, len(centroids))
        waiting, active = seen.copy(), np.arange(len(own))
        nearest = seen.min(axis=1)
        while len(active):
            best = waiting[active].argmin(axis=1)
            limit = np.maximum(ratio * np.maximum(nearest[active], floor), np.partition(seen[active], least - 1, axis=1)[:, least - 1])
            if beam is not None and beam < len(centroids):
                limit = np.minimum(limit, np.partition(seen[active], beam - 1, axis=1)[:, beam - 1])
            go = (waiting[active, best] <= limit) & np.isfinite(waiting[active, best])
            active, best = active[go], best[go]
            opened[active, best] = True
            near = graph[best]
            gap = np.sqrt(np.square(own[active][:, None, :] - centroids[near]).sum(axis=2))
            at = active[:, None]
            seen[at, near] = gap
            waiting[at, near] = np.where(opened[at, near], np.inf, gap)
            waiting[active, best] = np.inf
            nearest[active] = np.minimum(nearest[active], gap.min(axis=1))
        for r in range(len(own)):
            order = np.argsort(seen[r], kind="stable")
            order = order[np.isfinite(seen[r][order])]
            near = int((seen[r] <= ratio * max(nearest[r], floor)).sum())
            order = order[: max(near, least)][:beam]
            yield start + r, order, seen[r][order]


def boundary_lists(found: np.ndarray, gap: np.ndarray, floor: float) -> np.ndarray:
    """The lists a stored vector stands on: the nearest, and others hardly farther."""
    return found[gap <= BOUNDARY_RATIO * max(gap[0], floor)][:REPLICAS]


def calibrated_ratio(x: np.ndarray, longest: float, centroids: np.ndarray, graph: np.ndarray, floor: float, k: int) -> float:
    """The least ratio that reaches REACHED of the sample's true neighbours (500 sample queries)."""
    queries = x[np.random.default_rng(SEED).choice(len(x), size=min(500, len(x)), replace=False)]
    stored = lifted(x, longest)
    lists = np.full((len(x), REPLICAS), -1)
    for row, found, gap in walk(stored, centroids, graph, BOUNDARY_RATIO, floor, BEAM):
        own = boundary_lists(found, gap, floor)
        lists[row, : len(own)] = own
    lists = np.where(lists < 0, lists[:, :1], lists)
    to_lists = distances(as_query(queries), centroids)
    nearest = to_lists.min(axis=1)
    score = queries @ x.T
    top = np.argpartition(-score, min(k, len(x) - 1), axis=1)[:, : k + 1]
    needed = [to_lists[q][lists[top[q]]].min(axis=1) / max(nearest[q], floor, 1e-12) for q in range(len(queries))]
    return float(max(1.0, np.quantile(np.concatenate(needed), REACHED)))


def fit(vectors: DataFrame, rows: int, dim: int, k: int) -> dict:
    """Centroids, graph, ratio and the largest length.  The sample is the rows of least id hash."""
    longest = math.sqrt(vectors.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))).first()[0])
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").collect()
    x = np.array([r["vec"] for r in sample], dtype=np.float64).reshape(-1, dim)
    lists = max(1, min(math.ceil(math.sqrt(rows)), math.ceil(len(x) / 8)))
    centroids = balanced_centroids(lifted(x, longest), lists)
    graph = neighbour_graph(centroids)
    floor = float(np.median(distances(lifted(x[:2000], longest), centroids).min(axis=1)))
    ratio = calibrated_ratio(x, longest, centroids, graph, floor, k)
    return {"longest": longest, "centroids": centroids, "graph": graph, "dim": dim, "floor": floor, "ratio": ratio}


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def listed(vectors: DataFrame, index, stored: bool) -> DataFrame:
    """(list, near, vec_id, vec): a row for each list that a vector stands on, or that a query opens; nearest list 0."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, _WALK_ROWS):
                part = batch.slice(at, _WALK_ROWS)
                x = _matrix(part.column("vec"), fitted["dim"])
                x = lifted(x, fitted["longest"]) if stored else as_query(x)
                rows, lists, near = [], [], []
                ratio, beam = (BOUNDARY_RATIO, BEAM) if stored else (fitted["ratio"], None)
                for row, found, gap in walk(x, fitted["centroids"], fitted["graph"], ratio, fitted["floor"], beam):
                    found = boundary_lists(found, gap, fitted["floor"]) if stored else found
                    rows.append(np.full(len(found), row))
                    lists.append(found)
                    near.append(np.arange(len(found)))
                if rows:
                    own = part.take(pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(np.concatenate(x).astype(np.int32)) for x in (lists, near)], own.column("vec_id"), own.column("vec")],
                        names=["list", "near", "vec_id", "vec"],
                    )

    return vectors.select("vec_id", "vec").mapInArrow(assign, "list int, near int, vec_id long, vec array<float>")


def in_parts(df: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Each row in one part of its own side and in every part of the other side of its list."""
    return (
        df.join(sizes, "list")
        .withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(f"n_{own}")).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)))
        .drop("n_part", "n_qpart")
    )


def best_in_list(k: int, dim: int):
    def best(key, stored: pa.Table, asked: pa.Table) -> pa.Table:
        kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
        if not stored.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds})
        x, q = (_matrix(t.column("vec").combine_chunks(), dim) for t in (stored, asked))
        ids, queries = (np.asarray(t.column("vec_id")) for t in (stored, asked))
        bound = np.asarray(asked.column("bound"))
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(q), 256):
            score = q[at : at + 256] @ x.T
            score[queries[at : at + 256, None] == ids[None, :]] = -np.inf
            least = np.maximum(np.partition(score, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)], bound[at : at + 256])
            # The fast product may differ from the exact one in its last digits.
            slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(least), least, 0.0)))
            for r in range(len(score)):
                near = np.flatnonzero((score[r] >= least[r] - slack[r]) & (score[r] > -np.inf))
                exact = (x[near] * q[at + r]).sum(axis=1)
                order = np.lexsort((ids[near], -exact))[:k]
                order = order[exact[order] >= bound[at + r]]
                out[0].append(np.full(len(order), queries[at + r]))
                out[1].append(ids[near][order])
                out[2].append(exact[order])
        return pa.table({n: pa.array(np.concatenate(c), t) for (n, t), c in zip(kinds, out)})

    return best


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``.  A NULL id and vectors without a
    direction take no part; of repeated ids one row counts; vectors of another length than the
    others raise.  Further columns are ignored, an empty table gives no rows.
    """
    spark = vectors.sparkSession
    valid = staged(
        vectors.where(F.col("vec_id").isNotNull() & usable("embedding"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vec"))
        .dropDuplicates(["vec_id"]),
        "ann-vectors",
    )
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = valid.groupBy(F.size("vec").alias("dim")).count().limit(2).collect()
    if not lengths:
        return empty
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths")
    rows, dim = lengths[0]["count"], lengths[0]["dim"]
    index = spark.sparkContext.broadcast(fit(valid, rows, dim, k))  # bounded by SAMPLE_ROWS
    postings = staged(listed(valid, index, stored=True), "ann-lists")
    probes = staged(listed(valid.where(F.col("vec_id") % every == 0), index, stored=False), "ann-probes")
    stored_parts = F.broadcast(  # one row per centroid
        postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_PART_ROWS).cast("int").alias("n_part"))
    )

    def searched(asked: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): the k best of each opened list that reach the query's bound."""
        sizes = F.broadcast(
            asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_PART_ROWS).cast("int").alias("n_qpart")).join(stored_parts, "list")
        )
        left = in_parts(postings.drop("near"), sizes, "part", "qpart").groupBy("list", "part", "qpart")
        right = in_parts(asked, sizes, "qpart", "part").groupBy("list", "part", "qpart")
        return left.cogroup(right).applyInArrow(best_in_list(k, dim), "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        """(query_id, best): a vector stands on several lists; it counts once, then the best k stay."""
        return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(
            F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k).alias("best")
        )

    def hits(best: DataFrame) -> DataFrame:
        return best.select("query_id", F.posexplode("best").alias("pos", "hit")).select(
            "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
        )

    nowhere = F.lit(float("-inf"))
    narrow = ["list", "vec_id", "vec"]
    first = staged(ranked(searched(probes.where(F.col("near") < FIRST_LISTS).select(*narrow, nowhere.alias("bound")))), "ann-first")
    bounds = first.select(F.col("query_id").alias("vec_id"), F.when(F.size("best") >= k, F.element_at("best", -1)["score"]).alias("bound"))
    further = probes.where(F.col("near") >= FIRST_LISTS).join(bounds, "vec_id", "left").select(*narrow, F.coalesce("bound", nowhere).alias("bound"))
    again = first.select("query_id", F.explode("best").alias("hit")).select("query_id", "hit.vec_id", "hit.score")
    return hits(ranked(again.union(searched(further))))
