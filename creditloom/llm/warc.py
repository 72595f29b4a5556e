"""WARC archives through a chunked record table.

A payload is a run of rows (record_id, chunk_no, chunk); no step joins the chunks of a record again.
Digests are carried from chunk to chunk, archives are written chunk by chunk (one gzip member per
record) and read back as the same kind of rows.  Equal payloads are stored once: the others become
revisit records.

Recovery: a task writes its archive under a name of its own attempt; the manifest, a table that
Spark commits, lists the archives of successful attempts only.  A NULL payload is empty, a NULL url
leaves out its header, a NULL page_id is kept.  Every row is a record: of rows equal in every used
column the further ones are revisits of the first (responses, if the payload is below the least size for
revisits), and rows that share only a page_id are told apart by their content.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import scratch_path
from .common import staged, utf8_bytes

CHUNK_BYTES = 64 << 10
ARCHIVE_BYTES = 1 << 30
MIN_DEDUP_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 4 << 20
COPY_BLOCK = 100_000
# Identifiers of repeated rows, 40 bytes each
BROADCAST_ROWS = 200_000

CHUNK_KINDS = (
    "record_id string, record_type string, page_id long, target_uri string, refers_to long, "
    "declared_bytes long, declared_digest string, chunk_no long, last boolean, chunk binary"
)


def chunk_table(records: DataFrame, payload: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk; an empty payload is one empty chunk.  The other columns are repeated."""
    last = F.greatest(F.ceil(F.octet_length(payload) / chunk_bytes) - 1, F.lit(0)).cast("long")
    rest = [c for c in records.columns if c != payload]
    return (
        records.withColumn("__last", last)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), "__last")).alias("chunk_no"))
        .select(
            *rest,
            "chunk_no",
            (F.col("chunk_no") == F.col("__last")).alias("last"),
            F.substring(payload, (F.col("chunk_no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)).alias("chunk"),
        )
    )


def fold_digests(chunks: DataFrame, keep: list[str]) -> DataFrame:
    """(record_id, keep..., payload_bytes, payload_digest) from chunk rows in order.

    The chunks of a record must follow each other in a partition, as chunk_table and read_archives
    leave them; the digest state is carried over batches and anything else raises.
    """
    schema = {f.name: f.dataType.simpleString() for f in chunks.schema.fields}
    kept = ["record_id", *keep]
    kinds = ", ".join([f"{c} {schema[c]}" for c in kept] + ["payload_bytes long", "payload_digest string"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size, expected = hashlib.sha1(), 0, 0
        for batch in batches:
            ends, sizes, digests = [], [], []
            numbers, lasts = batch.column("chunk_no").to_pylist(), batch.column("last").to_pylist()
            for row, chunk in enumerate(batch.column("chunk")):
                if numbers[row] != expected:
                    raise ValueError(f"chunk {numbers[row]} where {expected} was expected")
                data = chunk.as_buffer()
                if data is not None:
                    digest.update(data)
                    size += len(data)
                expected += 1
                if lasts[row]:
                    ends.append(row)
                    sizes.append(size)
                    digests.append(base64.b32encode(digest.digest()).decode())
                    digest, size, expected = hashlib.sha1(), 0, 0
            done = batch.select(kept).take(pa.array(ends, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*done.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=[*kept, "payload_bytes", "payload_digest"],
            )
        if expected:
            raise ValueError("the last record has no final chunk")

    return chunks.select(*kept, "chunk_no", "last", "chunk").mapInArrow(fold, kinds)


def page_records(pages: DataFrame) -> DataFrame:
    """(record_id, page_id, url, payload); the identifier is a digest of the row."""
    identity = F.to_json(F.struct(F.col("page_id").cast("string"), F.col("url")), {"ignoreNullFields": "false"})
    body = utf8_bytes("html")
    return pages.select(
        F.md5(F.concat(identity.cast("binary"), body)).alias("record_id"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        body.alias("payload"),
    )


def _each_copy(rows: DataFrame) -> DataFrame:
    """A row per copy (column ``copies``), numbered in ``copy``; the first keeps its record_id.

    Copies are dealt in blocks, so that a page repeated without end is spread over tasks.
    """
    blocks = rows.withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPY_BLOCK)))
    )
    start = F.col("__block") * COPY_BLOCK
    numbered = blocks.withColumn(
        "copy", F.explode(F.sequence(start, F.least(start + COPY_BLOCK, F.col("copies")) - 1))
    ).drop("__block", "copies")
    later = F.md5(F.concat_ws(":", "record_id", F.col("copy").cast("string")).cast("binary"))
    return numbered.withColumn("record_id", F.when(F.col("copy") == 0, F.col("record_id")).otherwise(later))


def _repeated(digests: DataFrame) -> DataFrame:
    """(record_id, copies) of rows that are equal in every used column."""
    return digests.groupBy("record_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def unique_records(records: DataFrame, digests: DataFrame, min_bytes: int) -> DataFrame:
    """Records under identifiers of their own: further copies of a row have another one, and carry the
    payload only where they are no revisits."""
    repeated = staged(_repeated(digests), "warc-repeated")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    first = records.join(repeated, "record_id").dropDuplicates(["record_id"])
    small = F.octet_length("payload") < min_bytes
    copies = _each_copy(first).withColumn("payload", F.when((F.col("copy") == 0) | small, F.col("payload")))
    return records.join(repeated, "record_id", "left_anti").unionByName(copies.select(*records.columns))


def plan_records(digests: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Response or revisit for every record: of equal payloads the largest page_id is the response."""
    facts = [c for c in digests.columns if c != "record_id"]
    counted = digests.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in facts]
    )
    records = _each_copy(counted)
    firsts = records.where((F.col("copy") == 0) & (F.col("payload_bytes") >= min_bytes))
    same = firsts.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "record_id", "url")).alias("first")
    )
    joined = records.join(same, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & (F.col("first.record_id") != F.col("record_id"))
    return joined.select(
        "record_id",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
        F.when(revisit, F.col("first.record_id")).alias("refers_id"),
        F.when(revisit, F.col("first.url")).alias("refers_url"),
    )


def _urn(record_id: str) -> str:
    return f"<urn:uuid:{record_id[:8]}-{record_id[8:12]}-{record_id[12:16]}-{record_id[16:20]}-{record_id[20:]}>"


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields if v is not None]]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _uri(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def _record_start(r: dict) -> tuple[bytes, bytes]:
    """Header and the first part of the block (the HTTP head) of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
    revisit = r["record_type"] == "revisit"
    block = len(http) + (0 if revisit else r["payload_bytes"])
    fields = [
        ("WARC-Type", r["record_type"]),
        ("WARC-Record-ID", _urn(r["record_id"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(r["url"])),
        ("WARC-Payload-Digest", "sha1:" + r["payload_digest"]),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _urn(r["refers_id"]) if revisit else None),
        ("WARC-Refers-To-Target-URI", _uri(r["refers_url"]) if revisit else None),
        ("X-Page-ID", r["page_id"]),
        ("X-Refers-To-Page-ID", r["refers_to"]),
        ("X-Payload-Length", r["payload_bytes"]),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", block),
    ]
    return _head(fields), http


class _Archive:
    """One archive file, written record by record."""

    def __init__(self, folder: str, name: str):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        self.uri, self.records = f"{folder}/{name}", 0
        self._out = system.open_output_stream(f"{root}/{name}", compression=None)
        info = b"software: creditloom\r\nformat: WARC File Format 1.1\r\n"
        self.start()
        self.write(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(hashlib.md5(name.encode()).hexdigest())), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))]) + info)
        self.end()
        self.records = 0

    def start(self) -> None:
        self._member = zlib.compressobj(3, zlib.DEFLATED, 31)

    def write(self, data) -> None:
        self._out.write(self._member.compress(data))

    def end(self) -> None:
        self._out.write(self._member.compress(b"\r\n\r\n") + self._member.flush())
        self.records += 1

    @property
    def size(self) -> int:
        return self._out.tell()

    def close(self) -> tuple[str, int, int]:
        size = self.size
        self._out.close()
        return self.uri, size, self.records


def write_archives(chunks: DataFrame, plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all records below ``folder``; returns the manifest (uri, bytes, records), already stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        archive, done, current, expected, seq, unfinished = None, [], None, 0, 0, False
        for batch in batches:
            names = [c for c in batch.schema.names if c != "chunk"]
            columns = {c: batch.column(c).to_pylist() for c in names}
            for row, chunk in enumerate(batch.column("chunk")):
                record, number = columns["record_id"][row], columns["chunk_no"][row]
                if number != (expected if record == current else 0) or record != current and unfinished:
                    raise ValueError(f"record {record}: chunk {number} where {expected} was expected")
                if record != current:
                    if archive and archive.size >= archive_bytes:
                        done.append(archive.close())
                        archive = None
                    if archive is None:
                        archive = _Archive(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{seq:04d}.warc.gz")
                        seq += 1
                    head, http = _record_start({c: columns[c][row] for c in names})
                    archive.start()
                    archive.write(head + http)
                    current, expected, unfinished = record, 0, True
                data = chunk.as_buffer()
                if data is not None and columns["record_type"][row] == "response":
                    archive.write(data)
                expected += 1
                if columns["last"][row]:
                    archive.end()
                    unfinished = False
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["uri", "bytes", "records"],
        )

    # All chunks of a record come from one task and share the join key, so they stay together;
    # the writer raises if they did not.
    ordered = chunks.join(plan, "record_id").sortWithinPartitions("record_id", "chunk_no")
    return staged(ordered.mapInArrow(write, "uri string, bytes long, records long"), "warc-manifest")


def _parse_head(stream) -> dict[str, str] | None:
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _skip_http(stream, left: int) -> int:
    while left > 0:
        line = stream.readline(left)
        left -= len(line)
        if line in (b"\r\n", b"\n", b""):
            break
    return left


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The response and revisit records of the listed archives as chunk rows, in file order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("refers_to", pa.int64()),
             ("declared_bytes", pa.int64()), ("declared_digest", pa.string()), ("chunk_no", pa.int64()), ("last", pa.bool_()), ("chunk", pa.binary())]
        )
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                system, path = fs.FileSystem.from_uri(uri)
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    while (fields := _parse_head(stream)) is not None:
                        left = int(fields["content-length"])
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit"):
                            while left > 0:
                                left -= len(stream.read(min(left, chunk_bytes)))
                            continue
                        left = _skip_http(stream, left)
                        head = (
                            fields["warc-record-id"].strip("<>").removeprefix("urn:uuid:").replace("-", ""), kind, _number(fields.get("x-page-id")),
                            fields.get("warc-target-uri"), _number(fields.get("x-refers-to-page-id")), _number(fields.get("x-payload-length")),
                            fields["warc-payload-digest"].removeprefix("sha1:"),
                        )
                        number = 0
                        while True:
                            data = stream.read(min(left, chunk_bytes)) if left else b""
                            if left and not data:
                                raise ValueError(f"{uri} ends inside a record")
                            left -= len(data)
                            rows.append((*head, number, left == 0, data))
                            held += len(data) + 300
                            number += 1
                            if held >= _BATCH_BYTES:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                                rows, held = [], 0
                            if left == 0:
                                break
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = max(1, manifest.count())
    return manifest.select("uri").repartition(files).mapInArrow(read, CHUNK_KINDS)


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Write every page to WARC archives; returns the manifest."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records = page_records(pages)
    chunks = chunk_table(records, "payload")
    digests = staged(fold_digests(chunks, ["page_id", "url"]), "warc-digests")
    plan = plan_records(digests, min_bytes)
    unique = unique_records(records, digests, min_bytes)
    return write_archives(chunk_table(unique, "payload"), plan, folder)


def record_summary(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the archived records.

    Responses are measured from the stored bytes and must agree with their header; a revisit
    has no payload of its own and states that of the record it refers to.
    """
    measured = fold_digests(read_archives(manifest), ["page_id", "record_type", "refers_to", "declared_bytes", "declared_digest"])
    revisit = F.col("record_type") == "revisit"
    agrees = revisit | (
        (F.col("payload_digest") == F.col("declared_digest")) & (F.col("payload_bytes") == F.col("declared_bytes"))
    )
    checked = F.when(agrees, F.col("record_type")).otherwise(F.raise_error("a stored payload differs from its digest"))
    return measured.select(
        "page_id",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        checked.alias("record_type"),
        "refers_to",
    )
