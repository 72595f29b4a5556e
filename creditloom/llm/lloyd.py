"""Vector codes by Lloyd's method with members that stay where they are.

Vectors are cut into PARTS consecutive parts and every part position has a codebook of ENTRIES
vectors.  A part is a row (position, entry, salt, part) that lives with the owner of its entry: rows are
dealt once by those three keys and stored.  In a round each owner adds up its resident members, the
sums (a few numbers per entry) give the new codebook, and members look for their nearest entry again.
Those that keep it stay in place; only those that change it go through the next shuffle.  The salt
spreads an entry over as many owners as all rows would need, so one entry may hold most of the rows.

The codebooks are 64 times one vector, whatever the table; they and the 64 first vectors are all
that the driver sees.  Codes are written by one pass over the vectors with the last codebooks.

Defined cases: vectors that are NULL or hold NULL or non-finite components are left out; a vector
shorter than the longest, or lengths that 16 does not divide, are filled up with zeros; a NULL vec_id
sorts last; equal vec_ids sort by their vectors; of fewer than 64 rows each is an entry; repeated rows
are rows of their own; an empty table gives no rows; NULL labels are one label; other columns are
ignored.  Components beyond 65,535 in size end the run, since their squares would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import scratch_path
from .common import staged

PARTS, ENTRIES, ROUNDS, STEPS = 16, 64, 2, 256
OWNER_ROWS = 250_000
_LARGEST = 1 << 24
_BLOCK_ROWS = 8192
MEMBER_KINDS = "position int, entry int, salt int, part array<int>"


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of vectors with finite components only."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")
    )


def _steps(vectors: pa.Array, width: int) -> np.ndarray:
    """(row, position, component) whole steps of 1/256, short vectors filled with zeros."""
    sizes = vectors.value_lengths().to_numpy()
    flat = np.floor(STEPS * vectors.flatten().to_numpy())
    if len(flat) and np.abs(flat).max() > _LARGEST:
        raise ValueError(f"vector component beyond {_LARGEST // STEPS}")
    full = np.zeros((len(sizes), PARTS * width), np.int64)
    full[np.arange(PARTS * width) < sizes[:, None]] = flat.astype(np.int64)
    return full.reshape(len(sizes), PARTS, width)


def _nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest index of a nearest entry and the squared distance to it, per row."""
    distances = np.zeros((len(parts), len(book)), np.int64)
    for component in range(parts.shape[1]):
        distances += (parts[:, component, None] - book[None, :, component]) ** 2
    entry = distances.argmin(axis=1)
    return entry, distances[np.arange(len(parts)), entry]


def _members(position: np.ndarray, entry: np.ndarray, salt: np.ndarray, parts: np.ndarray) -> dict[str, pa.Array]:
    width = parts.shape[1]
    return {
        "position": pa.array(position.astype(np.int32)),
        "entry": pa.array(entry.astype(np.int32)),
        "salt": pa.array(salt.astype(np.int32)),
        "part": pa.ListArray.from_arrays(
            pa.array(np.arange(len(parts) + 1, dtype=np.int32) * width), pa.array(parts.ravel().astype(np.int32))
        ),
    }


def _parts_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("part").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of rows, none of them empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK_ROWS):
            yield batch.slice(start, _BLOCK_ROWS)


def first_members(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """Every part with the entry nearest to it at the start."""
    width = books.shape[2]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            steps = _steps(batch.column("embedding"), width)
            rows = np.arange(len(steps))
            for position in range(PARTS):
                parts = steps[:, position]
                entry, _ = _nearest(parts, books[position])
                yield pa.RecordBatch.from_pydict(_members(np.full(len(rows), position), entry, rows % salts, parts))

    return vectors.select("embedding").mapInArrow(deal, MEMBER_KINDS)


def look_again(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with the entry nearest to them now, and whether that is another one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            position, before = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
            parts, entry = _parts_of(batch), np.zeros(batch.num_rows, np.int64)
            for at in np.unique(position):
                here = position == at
                entry[here], _ = _nearest(parts[here], books[at])
            columns = _members(position, entry, batch.column("salt").to_numpy(), parts)
            yield pa.RecordBatch.from_pydict(columns | {"moved": pa.array(entry != before)})

    return members.mapInArrow(compare, MEMBER_KINDS + ", moved boolean")


def updated_books(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each entry's members; entries without members stay."""
    shape = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in _blocks(batches):
            position, entry = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
            np.add.at(sums, (position, entry), _parts_of(batch))
            np.add.at(counts, (position, entry), 1)
        used = np.argwhere(counts > 0)
        for component in range(shape[2]):
            yield pa.RecordBatch.from_pydict(
                {
                    "position": pa.array(used[:, 0].astype(np.int32)),
                    "entry": pa.array(used[:, 1].astype(np.int32)),
                    "component": pa.array(np.full(len(used), component, np.int32)),
                    "total": pa.array(sums[used[:, 0], used[:, 1], component]),
                    "members": pa.array(counts[used[:, 0], used[:, 1]]),
                }
            )

    kinds = "position int, entry int, component int, total long, members long"
    totals = members.mapInArrow(add_up, kinds).groupBy("position", "entry", "component")
    found = totals.agg(F.sum("total").alias("total"), F.sum("members").alias("members")).collect()
    new = books.copy()
    for r in found:  # at most one row per number of the codebooks
        new[r.position, r.entry, r.component] = r.total // r.members
    return new


def _owned(members: DataFrame, name: str) -> DataFrame:
    return staged(members.repartition("position", "entry", "salt"), name)


def trained_books(vectors: DataFrame, rows: int, width: int) -> np.ndarray:
    """Codebooks (position, entry, component) after ROUNDS rounds over all vectors."""
    spark = vectors.sparkSession
    lead = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).select("embedding").collect()
    starts = _steps(pa.array([r.embedding for r in lead], pa.list_(pa.float64())), width)
    books = np.ascontiguousarray(starts.transpose(1, 0, 2))
    members = _owned(first_members(vectors, books, -(-rows // OWNER_ROWS)), "members")
    for number in range(ROUNDS):
        if number:
            path = scratch_path(spark, "looked-again")
            look_again(members, books).write.partitionBy("moved").option("compression", "zstd").parquet(path)
            looked = spark.read.schema(MEMBER_KINDS + ", moved boolean").parquet(path)
            movers = _owned(looked.where("moved").drop("moved"), "moved-members")
            members = looked.where("NOT moved").drop("moved").unionByName(movers)
        books = updated_books(members, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part, and the squared distances added up."""
    width = books.shape[2]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            steps = _steps(batch.column("embedding"), width)
            codes, error = np.zeros((len(steps), PARTS), np.uint8), np.zeros(len(steps), np.int64)
            for position in range(PARTS):
                codes[:, position], distance = _nearest(steps[:, position], books[position])
                error += distance
            written = codes.tobytes().hex()
            texts = [written[at : at + 2 * PARTS] for at in range(0, len(written), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(write, f"vec_id long, label {label}, code string, error long")


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors as ``encode`` returns them, and the codebooks to decode them."""
    usable = usable_vectors(vectors)
    facts = usable.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("embedding")).alias("length")).first()
    width = -(-(facts.length or 0) // PARTS)
    if not facts.rows:
        return encode(usable, np.zeros((PARTS, 1, width), np.int64)), np.zeros((PARTS, 0, width), np.int64)
    books = trained_books(usable, facts.rows, width)
    return encode(usable, books), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of all usable vectors."""
    encoded, books = compress(vectors)
    codes = staged(encoded, "codes")
    labels = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(labels, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


# The same in SQL, for tables whose vectors all have the same length, a multiple of 16.
def oracle_sql() -> str:
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS (
  SELECT vec_id, label, position, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance
  FROM (SELECT p.vec_id, p.label, p.position, p.part, b.entry,
          list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
        FROM parts p JOIN {book} b USING (position))
  GROUP BY vec_id, label, position, part)"""

    def updated(name: str, before: str, members: str) -> str:
        return f"""{name} AS (
  SELECT b.position, b.entry, coalesce(m.part, b.part) AS part
  FROM {before} b LEFT JOIN (
    SELECT position, entry, list(mean ORDER BY i) AS part
    FROM (SELECT position, entry, i, CAST(floor(sum(part[i]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS mean
          FROM {members}, unnest(range(1, len(part) + 1)) AS u(i) GROUP BY position, entry, i)
    GROUP BY position, entry) m USING (position, entry))"""

    return f"""
WITH kept AS (
  SELECT vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS steps
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, position,
    steps[position * (len(steps) // 16) + 1 : (position + 1) * (len(steps) // 16)] AS part
  FROM kept, unnest(range(16)) AS u(position)),
lead AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT position, entry, part FROM parts JOIN lead USING (vec_id)),
{assigned("members0", "book0")},
{updated("book1", "book0", "members0")},
{assigned("members1", "book1")},
{updated("book2", "book1", "members1")},
{assigned("members2", "book2")},
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY position) AS code,
    CAST(sum(distance) AS BIGINT) AS error
  FROM members2 GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(CAST(part[i] AS VARCHAR), ',' ORDER BY position, entry, i)) AS codebooks_sha256
  FROM book2, unnest(range(1, len(part) + 1)) AS u(i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes, digest"""
