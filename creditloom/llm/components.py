"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every neighbour pair with the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("__v")).select(
        F.col("u").alias("__u"), F.least("u", "__v").alias("m")
    )
    return pairs.join(least, F.col("u") == F.col("__u")).select("u", "v", "m")


def _each_of(pairs: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """(u, v): the named columns of every row, one pair after the other.

    A union would hold the plan of ``pairs`` once per pair, and a round does so again and again.
    """
    made = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends])
    return pairs.select(F.explode(made).alias("__pair")).select("__pair.u", "__pair.v")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (src, dst; not NULL).

    Each round is written to the shared folder.  Neighbours are never collected per node: a node
    with very many links is one skewed join key, which adaptive execution splits.
    """
    current = staged(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(most_rounds):
        both = _each_of(current, ("u", "v"), ("v", "u"))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_least(large)
        current = staged(_each_of(small, ("v", "m"), ("u", "m")).where("u <> v").distinct(), "cc")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.union(roots.select(F.col("component").alias("node"), "component").distinct())
