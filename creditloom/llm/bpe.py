"""Byte-level BPE over a table of distinct words.

Texts are cut into words by Spark's regular expressions.  A block (some megabytes of documents)
keeps its distinct words once and its documents as positions into that list.  The list is dealt to
buckets by a hash of the word, one packed row per block and bucket.  In a bucket the words of all
blocks meet: each distinct word is encoded once and decoded by a join of its ids with the table of
pieces.  The answers go back to the blocks, where ids are placed by position.

Memory: a task holds one block, or the distinct words of one bucket while the blocks' rows of that
bucket stream by.  A word as frequent as a third of all rows costs one place per block.
Null text is empty; null and repeated ids are kept, one result row per input row; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed, size_slices, staged, staged_by
from .packed import text_bytes

BLOCK_BYTES = 20 << 20
BUCKET_BYTES = 16 << 20  # text per bucket of words
MOST_FILES = 10_000  # that blocks are dealt to; beyond that a file has several hundred megabytes of text
ASSEMBLED_DOCS = 500  # documents whose ids and texts are held at a time


def load_tokenizer(path: str):
    """The tokenizer, on one thread: a task has one core, and each further thread would keep memory of its own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [x["content"] for x in json.load(file)["added_tokens"]]


def word_pattern(specials: list[str]) -> str:
    """Java pattern of the words of a byte-level tokenizer; special strings are words of their own.

    The alternatives between the special strings and the end are the tokenizer's fixed pattern,
    made to stop before a special string as if the text ended there.
    """
    if not specials:
        return r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    special = "|".join(regex.escape(x, special_only=True) for x in sorted(specials, key=len, reverse=True))
    return (
        rf"(?U){special}|'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+"
        rf"| ?(?:(?!{special})[^\s\p{{L}}\p{{N}}])+|\s+(?!(?!{special})\S)|\s+"
    )


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece): the bytes of every id.  One row per vocabulary entry, whatever the corpus; made by a task, not by the driver."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = byte_of_char()

        def piece(token: str) -> bytes:
            if all(c in alphabet for c in token):
                return bytes(alphabet[c] for c in token)
            return token.encode()

        for _ in batches:
            rows = [(i, piece(t)) for t, i in load_tokenizer(path).get_vocab(with_added_tokens=True).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["id", "piece"])

    return spark.range(0, 1, 1, 1).mapInArrow(pieces, "id int, piece binary")


def squeeze(*parts: np.ndarray) -> bytes:
    """Arrays of bytes or of unsigned numbers as one compressed value."""
    raw = [x.tobytes() if x.dtype == np.uint8 else x.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes() for x in parts]
    whole = b"".join([np.array([len(x) for x in raw], "<i8").tobytes(), *raw])
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def unsqueeze(value: bytes, kinds: str) -> list[np.ndarray]:
    """The arrays of squeeze(); ``kinds`` has b for bytes and n for numbers."""
    whole = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    at, found = 8 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(whole, "<i8", len(kinds)).tolist()):
        part = np.frombuffer(whole, np.uint8, size, at)
        found.append(part if kind == "b" else np.ascontiguousarray(part.reshape(4, -1).T).view("<u4").ravel())
        at += size
    return found


def _spelling(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, bytes) of a binary array."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists), b"")
    return np.asarray(pc.binary_length(lists)), np.frombuffer(joined[0].as_buffer(), np.uint8)


def _strings(lengths: np.ndarray, raw: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def word_blocks(docs: DataFrame, pattern: str, buckets: int, files: int, block_bytes: int = BLOCK_BYTES, place: str | None = None) -> DataFrame:
    """(block, bucket, doc_ids, places, body): bucket -1 has a block's documents, the others its distinct words.

    Words are in order of bucket and spelling.  Documents name a word by its rank in frequency.
    ``places`` are the documents' values of ``place``, a column of ``docs`` (NULL without one).
    Blocks are stored dealt to ``files``, where the documents wait for their words.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, stop in size_slices(np.asarray(batch.column("size")), block_bytes):
                lists = batch.column("words").slice(start, stop - start)
                encoded = pc.dictionary_encode(lists.flatten())
                words = encoded.dictionary.cast(pa.binary())
                bucket = np.array([zlib.crc32(w) % buckets for w in words.to_pylist()], np.int32)
                order = np.asarray(pc.sort_indices(pa.table({"b": bucket, "w": words}), sort_keys=[("b", "ascending"), ("w", "ascending")])).astype(np.int64)
                place = np.empty(len(order), np.uint32)
                place[order] = np.arange(len(order))
                slots = place[np.asarray(encoded.indices)]
                del encoded
                often = np.bincount(slots, minlength=len(order))
                rank = np.empty(len(order), np.uint32)
                rank[np.argsort(-often, kind="stable")] = np.arange(len(order))
                number = (part << 32) + seq
                seq += 1
                counts = np.asarray(pc.list_value_length(lists))
                named = [batch.column(c).slice(start, stop - start).to_pylist() for c in ("doc_id", "place")]
                slots = rank[slots]
                out = [(number, -1, *named, squeeze(counts, often, slots))]
                del slots, lists
                words, bucket = words.take(pa.array(order)), bucket[order]
                cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]])
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    out.append((number, int(bucket[a]), None, None, squeeze(*_spelling(words.slice(a, b - a)))))
                listed = pa.list_(pa.int64())
                kinds = (pa.int64(), pa.int32(), listed, listed, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["block", "bucket", "doc_ids", "places", "body"])
                freed()

    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.col(place) if place else F.lit(None)).cast("long").alias("place"),
        F.octet_length(text).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("words"),
    )
    packed = cut.mapInArrow(pack, "block long, bucket int, doc_ids array<long>, places array<long>, body binary")
    return staged_by(packed, "bpe-blocks", "block", files)


def encode_words(packed: DataFrame, path: str) -> DataFrame:
    """(bucket, word, ids): every distinct word once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)

        def coded(bucket: int, words: pa.Array) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(words), 2000):
                own = words.slice(at, 2000)
                found = tokenizer.encode_batch(own.cast(pa.string()).to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_pydict(
                    {"bucket": pa.array([bucket] * len(own), pa.int32()), "word": own, "ids": pa.array([x.ids for x in found], pa.list_(pa.int32()))}
                )

        current, known = None, pa.array([], pa.binary())
        for batch in batches:
            for bucket, body in zip(batch.column("bucket").to_pylist(), batch.column("body")):
                if bucket != current:
                    yield from coded(current, known)
                    current, known = bucket, pa.array([], pa.binary())
                known = pc.unique(pa.concat_arrays([known, _strings(*unsqueeze(body.as_py(), "nb"))]))
        yield from coded(current, known)
        freed()

    ordered = packed.select("bucket", "body").repartition("bucket").sortWithinPartitions("bucket")
    return staged(ordered.mapInArrow(encode, "bucket int, word binary, ids array<int>"), "bpe-words")


def decode_ids(spark: SparkSession, coded: DataFrame, path: str) -> DataFrame:
    """(bucket, body): words with their ids and the bytes of these, by a join of each id with the piece table.

    The piece table has one row per vocabulary entry (about 50,000), so it is broadcast; the ids of a
    word come out of that join one after the other, as they went in.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            starts = np.flatnonzero(np.asarray(batch.column("pos")) == 0)
            if not len(starts):
                held.append(batch)
                continue
            # The last word may go on in the next batch.
            held.append(batch.slice(0, starts[-1]))
            yield spelled(held)
            held = [batch.slice(starts[-1])]
        if held:
            yield spelled(held)
        held.clear()
        freed()

    def spelled(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        starts = np.flatnonzero(np.asarray(table.column("pos")) == 0)
        ends = np.append(starts, table.num_rows).astype(np.int32)
        pieces = table.column("piece").combine_chunks() if table.num_rows else pa.array([], pa.binary())
        decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces), b"")
        words = table.column("word").take(pa.array(starts)).combine_chunks() if table.num_rows else pa.array([], pa.binary())
        bucket, ids = np.asarray(table.column("bucket"))[starts], np.asarray(table.column("id"))
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        out = [
            (int(bucket[a]), squeeze(*_spelling(words.slice(a, b - a)), np.diff(ends[a : b + 1]), ids[ends[a] : ends[b]], *_spelling(decoded.slice(a, b - a))))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        ]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["bucket", "body"])

    pieces = F.broadcast(piece_table(spark, path))
    rows = coded.select("bucket", "word", F.posexplode("ids").alias("pos", "id")).join(pieces, "id")
    return rows.select("bucket", "word", "pos", "id", "piece").mapInArrow(spell, "bucket int, body binary")


def answered(packed: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(block, bucket, body): ids and decoded bytes of a block's words, in the block's order of words."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, known = None, [], None
        for batch in batches:
            bucket, asks = np.asarray(batch.column("bucket")), np.asarray(batch.column("asks"))
            cuts = np.concatenate([np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(asks, prepend=-1) != 0)), [len(bucket)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if not asks[a]:
                    held = held if current == bucket[a] else []
                    current, known = bucket[a], None
                    held += [unsqueeze(x.as_py(), "nbnnnb") for x in batch.column("body").slice(a, b - a)]
                    continue
                if known is None:
                    lengths, raw, sizes, ids, widths, decoded = known = [np.concatenate(x) for x in zip(*held)]
                    words, spelled = _strings(lengths, raw), _strings(widths, decoded)
                    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                    held = []  # the arrays are joined in ``known``
                bodies = []
                for body in batch.column("body").slice(a, b - a):
                    at = pc.index_in(_strings(*unsqueeze(body.as_py(), "nb")), value_set=words)
                    own = lists.take(at)
                    bodies.append(squeeze(np.asarray(pc.list_value_length(own)), np.asarray(own.flatten()), *_spelling(spelled.take(at))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(a, b - a), batch.column("bucket").slice(a, b - a), pa.array(bodies, pa.binary())],
                    names=["block", "bucket", "body"],
                )
        freed()

    rows = lexicon.select("bucket", F.lit(0).alias("asks"), "body").unionByName(
        packed.select("bucket", F.lit(1).alias("asks"), "block", "body"), allowMissingColumns=True
    )
    # The words of a bucket come first, then the blocks that ask for them.
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "asks")
    return ordered.mapInArrow(answer, "block long, bucket int, body binary")


def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
    """(doc ids, places, id arrays, decoded bytes) of some documents after the others; a block's documents come first."""

    def placed(doc_ids: list, places: list, body: bytes, bodies: list[bytes]) -> Iterator[tuple[list, list, list, list]]:
        counts, often, ranks = unsqueeze(body, "nnn")
        found = list(zip(*[unsqueeze(x, "nnnb") for x in bodies])) or [[np.zeros(0, np.uint32)]] * 4
        sizes, flat, lengths, raw = (np.concatenate(x) for x in found)
        sizes = sizes.astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        ends = np.cumsum(lengths, dtype=np.int64).tolist()
        raw = raw.tobytes()
        spelled = [raw[a:b] for a, b in zip([0, *ends], ends)]
        by_rank = np.argsort(-often.astype(np.int64), kind="stable")
        ids, texts, at, first_doc = [], [], 0, 0
        for number, n in enumerate(counts.tolist(), 1):
            own = by_rank[ranks[at : at + n]]
            at += n
            width = sizes[own]
            first = np.repeat(starts[own] - (np.cumsum(width) - width), width)
            ids.append(flat[first + np.arange(int(width.sum()))])
            texts.append(b"".join([spelled[s] for s in own.tolist()]))
            if len(texts) == ASSEMBLED_DOCS or number == len(counts):
                yield doc_ids[first_doc:number], places[first_doc:number], ids, texts
                ids, texts, first_doc = [], [], number

    current, bodies = None, []
    for batch in batches:
        for row in range(batch.num_rows):
            body = batch.column("body")[row].as_py()
            if batch.column("bucket")[row].as_py() >= 0:
                bodies.append(body)
                continue
            if current:
                yield from placed(*current, bodies)
                freed()
            current, bodies = (*[batch.column(c)[row].as_py() for c in ("doc_ids", "places")], body), []
    if current:
        yield from placed(*current, bodies)
    freed()


def encode_documents(
    spark: SparkSession, docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, place: str | None = None
) -> DataFrame:
    """(block, bucket, doc_ids, places, body) rows for assembled(): documents of a block, then its encoded words.

    The documents, the larger part, stay where they were stored; the words are dealt to them.
    """
    size = text_bytes(docs)
    files = min(1 + size // BLOCK_BYTES, MOST_FILES)
    blocks = word_blocks(docs, word_pattern(special_strings(path)), 1 + size // BUCKET_BYTES, files, block_bytes, place)
    packed = blocks.where("bucket >= 0").select("block", "bucket", "body")
    lexicon = decode_ids(spark, encode_words(packed, path), path)
    coded = answered(packed, lexicon).repartition(files, "block").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "body"))).alias("words"))

    def row(bucket: Column, doc_ids: Column, places: Column, body: Column) -> Column:
        return F.struct(bucket.alias("bucket"), doc_ids.alias("doc_ids"), places.alias("places"), body.alias("body"))

    nothing = F.lit(None).cast("array<long>")
    first = F.array(row(F.col("bucket"), F.col("doc_ids"), F.col("places"), F.col("body")))
    further = F.transform("words", lambda x: row(x["bucket"], nothing, nothing, x["body"]))
    whole = blocks.where("bucket < 0").join(coded, "block", "left")
    return whole.select("block", F.inline(F.when(F.col("words").isNull(), first).otherwise(F.concat(first, further))))


def token_table(spark: SparkSession, docs: DataFrame, path: str, place: str | None = None) -> DataFrame:
    """(doc_id, place, ids, text): the token ids of every document and the text they decode to.

    ``place`` names a whole-number column of ``docs`` that goes along; without it the place is NULL.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, places, ids, texts in assembled(batches):
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "place": pa.array(places, pa.int64()),
                    "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    "text": pa.array([x.decode("utf-8", "replace") for x in texts], pa.string()),
                }
            )

    kinds = "doc_id long, place long, ids array<int>, text string"
    return encode_documents(spark, docs, path, place=place).mapInArrow(spread, kinds)


def token_digests(spark: SparkSession, docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, _, ids, texts in assembled(batches):
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array(
                        [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in texts], pa.string()
                    ),
                }
            )

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode_documents(spark, docs, path, block_bytes).mapInArrow(digest, kinds)
