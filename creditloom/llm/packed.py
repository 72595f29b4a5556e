"""Finding 64-bit keys that several documents share, a few bytes per key.

Keys of a slice of documents are dealt to buckets; a row is (slice, bucket) with 32 bits of each key and
its owner.  Buckets grow in number with the data, so the chance that two different keys of a bucket
agree in 32 bits stays the same at every size; such a chance only adds a candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import shuffles_freed

BUCKET_KEYS = 1_000_000
PACKED_KINDS = "slice long, bucket int, prints binary, owners binary"
_U = np.uint64


def packed_keys(keys: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | low 32 bits, as signed 64-bit values."""
    return ((((keys >> _U(32)) % _U(buckets)) << _U(32)) | (keys & _U(0xFFFFFFFF))).view(np.int64)


def packed_rows(number: int, keys: np.ndarray, owners: np.ndarray, buckets: int) -> list[tuple]:
    """(slice, bucket, prints, owners) rows of one slice."""
    packed = packed_keys(keys, buckets)
    order = np.argsort(packed >> 32, kind="stable")
    bucket = (packed >> 32)[order]
    low, owner = (packed & 0xFFFFFFFF).astype(np.uint32)[order], owners.astype(np.uint32)[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [
        (number, int(bucket[a]), low[a:b].tobytes(), owner[a:b].tobytes())
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        if b > a
    ]


def packed_once(number: int, keys: np.ndarray, owners: np.ndarray, buckets: int) -> list[tuple]:
    """packed_rows of the distinct pairs of key and owner, by plain sorting of numbers that hold both."""
    packed, bits = packed_keys(keys, buckets), int(owners.max(initial=0)).bit_length()
    if 32 + (buckets - 1).bit_length() + bits <= 63:
        both = np.sort((packed << bits) | owners)
        packed, owners = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.lexsort((owners, packed))
        packed, owners = packed[order], owners[order]
    once = np.flatnonzero(np.append(True, (packed[1:] != packed[:-1]) | (owners[1:] != owners[:-1]))[: len(packed)])
    packed, owners = packed[once], owners[once].astype(np.uint32)
    bucket, low = packed >> 32, (packed & 0xFFFFFFFF).astype(np.uint32)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [
        (number, int(bucket[a]), low[a:b].tobytes(), owners[a:b].tobytes())
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        if b > a
    ]


def shared_keys(slices: DataFrame) -> DataFrame:
    """(slice, owner, key, many) for the keys with at least two rows; ``many`` is their number.

    A bucket is met by one row per slice and holds about BUCKET_KEYS keys.
    """

    def find(key, table):
        prints = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("prints")]
        flat = np.concatenate(prints)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        sizes = np.diff(np.append(starts, len(ranked)))
        many = np.empty(len(flat), dtype=np.int64)
        many[order] = np.repeat(sizes, sizes)
        shared = many > 1
        row = np.repeat(np.arange(len(prints)), [len(x) for x in prints])[shared]
        owners = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("owners")])[shared]
        return pa.table(
            {
                "slice": table.column("slice").combine_chunks().take(pa.array(row)),
                "owner": pa.array(owners.astype(np.int64)),
                "key": pa.array(flat[shared].astype(np.int64) + (int(key[0].as_py()) << 32)),
                "many": pa.array(many[shared]),
            }
        )

    rows = slices.where("bucket >= 0").select("bucket", "slice", "prints", "owners")
    return rows.groupBy("bucket").applyInArrow(find, "slice long, owner long, key long, many long")


def bucket_count(total_bytes: int, bytes_per_key: int) -> int:
    return max(1, -(-total_bytes // (BUCKET_KEYS * bytes_per_key)))


def text_bytes(docs: DataFrame) -> int:
    with shuffles_freed(docs.sparkSession):
        return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
