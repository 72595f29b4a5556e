"""Repeated byte strings across documents by interval expansion on a Burrows-Wheeler transform.

1. Anchors.  Of every 50 bytes the 24-byte piece with the least hash is their anchor, so equal strings
   have equal anchors.  Shorter pieces meet by chance, the more the more documents there are.  Anchor fingerprints are packed per slice of documents and bucket, and each
   bucket finds those of two documents or more.  Only strings with such an anchor can repeat.
2. Segments.  The bytes around a shared anchor (all strings that have it) go to that anchor's task;
   equal segments are one string with its least document.
3. Transform.  The distinct segments of a task, some megabytes at a time, are one text.  From its
   Burrows-Wheeler order, intervals of suffixes with an equal prefix are extended backward, all of one
   length at once: lengths 1, 2, 4, ... until the minimum length.  Suffixes that no boundary has
   parted by then start with an equal string, and the least document of each interval is its first.
4. Every document takes out the strings whose first document is a smaller one.

An anchor with very many distinct segments is split: its strings are compared one by one, keyed by
their own bytes, so no task holds it whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, staged
from .packed import PACKED_KINDS, bucket_count, packed_keys, packed_once, shared_keys, text_bytes
from .shingles import mixed

MIN_BYTES = 50
ANCHOR_BYTES = 24
SLICE_BYTES = 2 << 20
ANCHOR_STRIDE = 14
BLOCK_BYTES = 1 << 14  # bytes of text whose hashes and minima stay in the processor's cache
HOT_DOCUMENTS = 500_000  # segments of one anchor then take about 40 MB at most
TRANSFORM_BYTES = 2 << 20
SOLVED_ROWS = 100_000  # rows whose starts are written out at a time
_CODES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
_U = np.uint64


def anchor_places(data: np.ndarray, least: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each string, hash of each piece) of one text; strings are ``least`` bytes long.

    The anchor is the leftmost piece of least hash inside the string, so it depends on the string alone.
    """
    n = len(data) - piece + 1
    with np.errstate(over="ignore"):
        value = _CODES[data]
        width = 1
        while width < piece:
            more = min(width, piece - width)  # the last two parts of a piece may overlap
            value = value[: len(value) - more] * _U(0x9E3779B97F4A7C15) + (value[more:] ^ (value[more:] >> _U(29)))
            width += more
        hashes = mixed(value[:n])
    # Sliding minimum of (hash, place): the place sits in the low bits of a shortened hash.
    span = least - piece + 1
    order = (hashes >> _U(24) << _U(24)) | np.arange(n, dtype=np.uint64)
    best, width = order, 1
    while width * 2 <= span:
        best = np.minimum(best[: len(best) - width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: len(best) - (span - width)], best[span - width :])
    return (best & _U(0xFFFFFF)).astype(np.int64), hashes


def _long_anchor_places(data: np.ndarray, least: int, piece: int, step: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """anchor_places for texts of any length, in overlapping pieces of ``step`` bytes."""
    if len(data) <= step + least:
        return anchor_places(data, least, piece)
    places, hashes = [], []
    for at in range(0, len(data) - least + 1, step):
        own = data[at : at + step + least - 1]
        p, h = anchor_places(own, least, piece)
        places.append(p + at)
        last = at + step >= len(data) - least + 1
        hashes.append(h if last else h[:step])
    return np.concatenate(places), np.concatenate(hashes)


def anchor_runs(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, n, hash of the anchor): runs of strings with one anchor, by row and start.

    The texts lie end to end and are worked on together; strings that would cross their ends are left out.
    """
    held = texts.cast(pa.large_binary())
    bounds = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    if len(data) < least:
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))
    places, hashes = _long_anchor_places(data, least, min(ANCHOR_BYTES, least), BLOCK_BYTES)
    past = np.maximum(bounds[:-1], bounds[1:] - least + 1)  # where a text has no more strings
    cuts = np.sort(np.concatenate([np.flatnonzero(places[1:] != places[:-1]) + 1, bounds[:-1], past]))
    cuts = cuts[np.append(True, cuts[1:] != cuts[:-1]) & (cuts < len(places))]
    row = np.searchsorted(bounds, cuts, side="right") - 1
    own = cuts < past[row]
    n = np.diff(np.append(cuts, len(places)))[own]
    cuts, row = cuts[own], row[own]
    return row, cuts - bounds[row], n, hashes[places[cuts]]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for row, text in enumerate(batch.column("text")):
        yield row, np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)


def anchor_slices(docs: DataFrame, buckets: int, least: int) -> DataFrame:
    """Per slice and bucket the documents' distinct anchors; bucket -1 has the documents themselves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        names = ["slice", "bucket", "prints", "owners", "doc_ids", "sizes", "digests"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
        for batch in batches:
            for start, stop in byte_slices(batch.column("text"), SLICE_BYTES):
                own = batch.slice(start, stop - start)
                sizes, digests = [], []
                for _, data in _texts(own):
                    sizes.append(len(data))
                    digests.append(hashlib.sha256(data).digest())
                owners, _, _, prints = anchor_runs(own.column("text"), least)
                number = (part << 32) + seq
                seq += 1
                out = [(number, -1, None, None, own.column("doc_id").to_pylist(), sizes, digests)]
                out += [(*r, None, None, None) for r in packed_once(number, prints, owners, buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return text.mapInArrow(cut, f"{PACKED_KINDS}, doc_ids array<long>, sizes array<long>, digests array<binary>")


def _among(keys: np.ndarray, wanted: pa.ListScalar) -> np.ndarray:
    """Which of the keys are among the wanted ones."""
    if not len(wanted):
        return np.zeros(len(keys), dtype=bool)
    ranked = np.sort(np.asarray(wanted.values))
    return ranked[np.minimum(np.searchsorted(ranked, keys), len(ranked) - 1)] == keys


def segments(text: DataFrame, shared: DataFrame, buckets: int, least: int) -> DataFrame:
    """(anchor, doc_id, start, n, bytes, hot): the strings around each shared anchor, as one segment each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, stop in byte_slices(batch.column("text"), SLICE_BYTES):
                own = batch.slice(begin, stop - begin)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
                columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in kinds]
                strings: list[bytes] = []
                ids = own.column("doc_id").to_pylist()
                rows, firsts, runs, prints = anchor_runs(own.column("text"), least)
                packed = packed_keys(prints, buckets)
                ends = np.searchsorted(rows, np.arange(len(own) + 1))
                for row, data in _texts(own):
                    part = slice(ends[row], ends[row + 1])
                    wanted = np.flatnonzero(_among(packed[part], own.column("anchors")[row])) + ends[row]
                    hot = _among(packed[wanted], own.column("hot_anchors")[row])
                    raw, starts, n = data.tobytes(), firsts[wanted], runs[wanted]
                    strings += [raw[a:b] for a, b in zip(starts.tolist(), (starts + n + (least - 1)).tolist())]
                    for c, v in zip(columns, (prints[wanted].view(np.int64), np.full(len(n), ids[row]), starts, n, hot)):
                        c.append(v)
                anchor, doc_id, at, n, hot = (pa.array(np.concatenate(c).astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds))
                yield pa.RecordBatch.from_arrays([anchor, doc_id, at, n, pa.array(strings, pa.binary()), hot], names=["anchor", "doc_id", "start", "n", "bytes", "hot"])

    joined = text.join(shared, "doc_id").select("doc_id", "text", "anchors", "hot_anchors")
    return joined.mapInArrow(cut, "anchor long, doc_id long, start long, n int, bytes binary, hot boolean")


def _sorted_keys(key: np.ndarray, key_bits: int, place_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order and their places; equal keys keep their order.

    A key and its place share a number: plain sorting is several times faster than argsort.  Where they
    do not fit, the lower half of the keys is sorted first.
    """
    if key_bits + place_bits <= 63:
        both = np.sort((key << place_bits) | np.arange(len(key)))
        return both >> place_bits, both & ((1 << place_bits) - 1)
    half = key_bits // 2
    _, order = _sorted_keys(key & ((1 << half) - 1), half, place_bits)
    _, again = _sorted_keys(key[order] >> half, key_bits - half, place_bits)
    order = order[again]
    return key[order], order


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in order of their suffixes; 0 ends a string, equal suffixes keep the text's order."""
    n = len(text)
    # Symbols that do not occur take no room in the first key.
    used = np.bincount(text) > 0
    used[0] = True
    codes = (np.cumsum(used) - 1).astype(np.int64)
    bits = max(1, int(codes[-1]).bit_length())
    place_bits = max(1, (n - 1).bit_length())
    length = max(1, min((63 - place_bits) // bits, 32))
    padded = np.concatenate([codes[text], np.zeros(length, np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(length):
        key = (key << bits) | padded[i : i + n]
    del padded
    ranked, order = _sorted_keys(key, length * bits, place_bits)
    longest = int(np.diff(np.flatnonzero(np.append(text, 0) == 0), prepend=-1).max())
    rank = np.zeros(n, dtype=np.int64)
    while True:
        rank[order] = 1 + np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        most = int(rank[order[-1]])
        if length > longest or most == n:
            return order
        rank_bits = most.bit_length()
        key = rank << rank_bits
        key[: n - length] |= rank[length:]  # longest < n, so this is reached with length < n only
        ranked, order = _sorted_keys(key, 2 * rank_bits, place_bits)
        length *= 2


def equal_prefix_intervals(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Interval number of every suffix in order; suffixes of one interval agree in ``least`` bytes or more.

    The text ends its strings with 0.  The column before the sorted suffixes is the transform; its
    stable order leads from a suffix to the one that is a byte shorter, and taken twice, four times and
    so on to the one that is as many bytes shorter.  A boundary between two suffixes at length k + m
    (m up to k) lies where one lies at length k, or at length k between the two that are m bytes shorter.
    So all intervals of one length are extended at a time, to twice their length and at last to ``least``,
    and a place whose common prefix is known is not looked at again.
    """
    n = len(order)
    before = text[order - 1]  # two bytes a symbol are sorted by counting
    steps = [np.argsort(before, kind="stable").astype(np.int32 if n < 1 << 31 else np.int64)]
    head = text[order]
    boundary = np.ones(n, dtype=bool)
    boundary[1:] = (head[1:] != head[:-1]) | (head[1:] == 0)
    open_ = np.flatnonzero(~boundary)
    length = 1
    while length < least:
        more = min(length, least - length)
        while 1 << len(steps) <= more:
            steps.append(steps[-1][steps[-1]])
        here, above = open_, open_ - 1
        for power, step in enumerate(steps):
            if more >> power & 1:
                here, above = step[here], step[above]
        interval = np.cumsum(boundary, dtype=np.int32)
        parted = interval[here] != interval[above]
        boundary[open_[parted]] = True
        open_ = open_[~parted]
        length += more
    return np.cumsum(boundary) - 1


def first_documents(strings: list[bytes], docs: np.ndarray, counts: np.ndarray, least: int) -> list[np.ndarray]:
    """For each segment and string start the least document with that string among the segments."""
    sizes = np.array([len(s) + 1 for s in strings])
    text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    ends = np.cumsum(sizes)
    text[ends - 1] = 0
    order = suffix_order(text)
    # The rotation before the first suffix is the last end mark: ends keep the text's order.
    interval = equal_prefix_intervals(text, order, least)
    owner = np.repeat(np.arange(len(strings)), sizes)
    inside = np.arange(len(text)) - np.repeat(ends - sizes, sizes)
    whole = inside < counts[owner]
    own_doc = np.where(whole, docs[owner], np.iinfo(np.int64).max)[order]
    starts = np.flatnonzero(np.diff(interval, prepend=-1))
    lowest = np.minimum.reduceat(own_doc, starts)
    first = np.empty(len(text), dtype=np.int64)
    first[order] = lowest[interval]
    begins = ends - sizes
    return [first[b : b + c] for b, c in zip(begins.tolist(), counts.tolist())]


def resolved_segments(found: DataFrame, least: int) -> DataFrame:
    """(doc_id, starts): strings of the segments whose first document is a smaller one.

    Segments of one anchor come to one task in a row; some megabytes are transformed at a time.
    """

    def solved(rows: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        anchors, docs = np.asarray(table.column("anchor")), np.asarray(table.column("doc_id"))
        coded = pc.dictionary_encode(table.column("bytes").combine_chunks())
        kind = np.asarray(coded.indices).astype(np.int64)
        counts = np.zeros(len(coded.dictionary), dtype=np.int64)
        counts[kind] = np.asarray(table.column("n"))
        doc = np.full(len(counts), np.iinfo(np.int64).max)
        np.minimum.at(doc, kind, docs)
        # A segment that is the only one of its anchor has no string in common with another.
        anchor_of = np.zeros(len(counts), dtype=np.int64)
        anchor_of[kind] = anchors
        _, back, kinds = np.unique(anchor_of, return_inverse=True, return_counts=True)
        several = np.flatnonzero(kinds[back] > 1)
        parted = []
        if len(several):
            strings = coded.dictionary.take(pa.array(several)).to_pylist()
            parted = zip(several.tolist(), first_documents(strings, doc[several], counts[several], least))
        first, begins = np.repeat(doc, counts), np.cumsum(counts) - counts
        for k, own in parted:
            first[begins[k] : begins[k] + counts[k]] = own
        starts, found = np.asarray(table.column("start")), []
        for a in range(0, len(docs), SOLVED_ROWS):
            own, n = kind[a : a + SOLVED_ROWS], counts[kind[a : a + SOLVED_ROWS]]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            row = np.repeat(np.arange(len(n)), n)
            hit = first[begins[own][row] + inside] < docs[a : a + SOLVED_ROWS][row]
            many = np.bincount(row[hit], minlength=len(n))
            some = np.flatnonzero(many)
            ends = np.concatenate([[0], np.cumsum(many[some])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((inside + starts[a : a + SOLVED_ROWS][row])[hit].astype(np.int64)))
            found.append(pa.RecordBatch.from_arrays([pa.array(docs[a : a + SOLVED_ROWS][some].astype(np.int64)), lists], names=["doc_id", "starts"]))
        return found

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchors = np.asarray(batch.column("anchor"))
            ends = np.cumsum(np.asarray(pc.binary_length(batch.column("bytes"))))
            changes = np.flatnonzero(np.diff(anchors) != 0) + 1
            at = 0
            if held and len(anchors) and held[-1].column("anchor")[-1].as_py() != anchors[0] and size >= TRANSFORM_BYTES:
                yield from solved(held)
                held, size = [], 0
            while at < len(anchors):
                base = int(ends[at - 1]) if at else 0
                room = base + max(0, TRANSFORM_BYTES - size)
                # The first change of anchor after the room is used up.
                later = changes[(changes > at) & (ends[np.maximum(changes - 1, 0)] >= room)]
                stop = int(later[0]) if len(later) else len(anchors)
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1]) - base
                if len(later):
                    yield from solved(held)
                    held, size = [], 0
                at = stop
        if held:
            yield from solved(held)

    ordered = found.select("anchor", "doc_id", "start", "n", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(resolve, "doc_id long, starts array<long>")


def resolved_strings(found: DataFrame, least: int) -> DataFrame:
    """(doc_id, starts) as above, with every string as a key of its own: for anchors in very many documents."""
    strings = found.select(
        "doc_id", "start", F.posexplode(F.transform(F.sequence(F.lit(1), "n"), lambda i: F.substring("bytes", i, F.lit(least)))).alias("at", "string")
    )
    firsts = strings.groupBy("string").agg(F.min("doc_id").alias("least"))
    return strings.join(firsts, "string").where("least < doc_id").select("doc_id", F.array(F.col("start") + F.col("at")).alias("starts"))


def merged_spans(starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs covered by strings of ``least`` bytes at the (sorted) starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > least)
    begins = starts[np.concatenate([[0], cut + 1])]
    ends = starts[np.concatenate([cut, [len(starts) - 1]])] + least
    return list(zip(begins.tolist(), ends.tolist()))


def binary_texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )


def repeated_strings(docs: DataFrame, least: int = MIN_BYTES, hot: int = HOT_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(known, removed): every document with n_bytes, digest and first copy; (doc_id, starts) of strings.

    ``first`` is the least doc_id with the same text.  ``starts`` covers only first copies.
    """
    buckets = bucket_count(text_bytes(docs), ANCHOR_STRIDE)
    slices = staged(anchor_slices(docs, buckets, least), "suffix-anchors")
    listed = slices.where("bucket < 0").select("slice", F.posexplode(F.arrays_zip("doc_ids", "sizes", "digests")).alias("owner", "d"))
    known = listed.select("slice", "owner", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("n_bytes"), F.col("d.digests").alias("digest"))
    copies = known.groupBy("digest", "n_bytes").agg(F.min("doc_id").alias("first"))
    known = staged(known.join(copies, ["digest", "n_bytes"]), "suffix-docs")
    reps = known.where("doc_id = first").select("slice", F.col("owner").cast("long").alias("owner"), "doc_id")
    # An anchor counts when two different texts have it; copies were counted as well above.
    met = staged(shared_keys(slices).join(reps, ["slice", "owner"]).select("doc_id", "key", "many"), "suffix-met")
    again = met.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key")
    per_doc = met.join(again, "key").groupBy("doc_id").agg(
        F.collect_list("key").alias("anchors"), F.collect_list(F.when(F.col("many") > hot, F.col("key"))).alias("hot_anchors")
    )
    found = staged(segments(binary_texts(docs), per_doc, buckets, least), "suffix-segments")
    if not met.where(F.col("many") > hot).isEmpty():
        return known, resolved_segments(found.where("not hot"), least).unionByName(resolved_strings(found.where("hot"), least))
    return known, resolved_segments(found, least)


def without_repeats(docs: DataFrame, least: int = MIN_BYTES, hot: int = HOT_DOCUMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    NULL texts are empty.  Rows without an id are never first and lose nothing; rows that share an id
    are not smaller than each other, and rows equal in id and text get equal results.
    """
    docs = docs.select("doc_id", "text")
    known, removed = repeated_strings(docs, least, hot)
    # Texts, segments and starts are shuffled one after the other, so their files are not on disk together.
    removed = staged(removed.groupBy("doc_id").agg(F.flatten(F.collect_list("starts")).alias("starts")), "suffix-starts")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, data in _texts(batch):
                spans = merged_spans(np.unique(np.asarray(batch.column("starts")[row].values)), least)
                digest, at, gone = hashlib.sha256(), 0, 0
                for start, end in spans:
                    digest.update(data[at:start])
                    gone += end - start
                    at = end
                digest.update(data[at:])
                out.append((gone, len(spans), digest.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]],
                names=["__id", "__removed", "__spans", "__kept"],
            )

    cut = binary_texts(docs).join(removed, "doc_id").mapInArrow(keep, "__id long, __removed long, __spans long, __kept string").dropDuplicates(["__id"])
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= least)
    nothing = hashlib.sha256(b"").hexdigest()
    joined = known.join(cut, (F.col("doc_id") == F.col("__id")) & (F.col("doc_id") == F.col("first")), "left")
    whole = F.lower(F.hex("digest"))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("__removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("__spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("__kept", whole)).alias("kept_sha256"),
    )
