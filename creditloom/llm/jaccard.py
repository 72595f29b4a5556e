"""N-gram Jaccard join over a token-group matrix.

Documents with equal shingle sets are one class.  Similar classes are put into small groups; a
group keeps the union of its members' shingles and, per member, the row of the matrix over that union.
Two groups are bounded by sketches of their unions alone (shingles counted in hash cells), which are a
twentieth of a group or less; only pairs whose bound reaches the threshold are brought together whole.
A member of one group then opens another group only if it shares enough shingles with the union; inside
an opened group every member is compared exactly.

Which pairs of groups are bounded at all comes from an exact filter: a set of up to n shingles is
cut by hash into more parts than two linked sets can differ in, so linked sets have at least one
equal part.  Parts are (part number, sum of its hashes); a part is an equality join key shared only by
documents that agree in the shingles of a part.  Empty parts are no keys: a set with too many of them is
cut anew, see part_keys().  A set leaves out as many of its most frequent keys as it can spare.  Group pairs that are already in one component need
no further comparison, so a large set of near copies is first tied to the least group of each part and
the rest is looked at between components only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, freed, staged
from .components import components
from .packed import PACKED_KINDS, bucket_count, packed_rows, shared_keys, text_bytes
from .shingles import mixed, shingle_sets

GROUP_MEMBERS = 128
_SLICE_BYTES = 2 << 20
SPARE_PERCENT = 12  # of the parts two linked sets can differ in; sets of either neighbouring class have fewer empty parts
TURNS = 8  # cuts into parts, for sets that have as many empty parts as spare ones in those before
_PARTS_SALT, _SUM_SALT, _KEY_SALT, _CELL_SALT = 101, 102, 103, 104
_U = np.uint64
DOCUMENT = ["doc_id", "n", "same", "same2", "alike", "loose", "loose_next"]


@lru_cache(maxsize=None)
def size_steps(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Lower ends of size classes: linked sets lie in one class or in neighbouring ones."""
    steps = [1]
    while steps[-1] < most:
        steps.append(max(steps[-1] + 1, -(-steps[-1] * 100 // percent)))
    return np.array(steps, dtype=np.int64)


def parts_of(size_class: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(parts, spare) for a larger set of this class: more parts than linked sets can differ in.

    100 * shared >= percent * union lets them differ in (|a| + |b|) * (100 - percent) / (100 + percent)
    shingles and no more parts; the spare parts come on top, so that many equal parts are left.
    """
    largest = size_steps(percent)[size_class + 1] - 1
    differ = 2 * largest * (100 - percent) // (100 + percent)
    spare = np.where(differ > 0, 1 + -(-differ * SPARE_PERCENT // 100), 1)
    return differ + spare, spare


def part_keys(
    hashes: np.ndarray, text: np.ndarray, size_class: np.ndarray, percent: int, turn: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, loose): a key per part and text, for sets counted as class ``size_class``, in the cut ``turn``.

    Linked sets have as many equal parts as there are spare ones or more.  Parts without a shingle say
    nothing, all texts of a class would meet there, so they are left out; where one of two linked sets
    has fewer empty parts than spare ones, an equal part is left.  Other texts (loose < 0) list the keys of
    the next turn as well, and so on: two linked sets both list the first turn that suits one of them.
    In the last turn empty parts are listed by texts that it does not suit either.

    So linked sets have more than ``loose`` listed keys of that turn in common, for the one it suits.  In
    one order of all keys the first of these has the others behind it, so it is not among the last
    ``loose`` keys of that text: the text can do without its last ones, and one with loose < 0 keeps all.
    """
    parts, spare = parts_of(size_class, percent)
    first = np.concatenate([[0], np.cumsum(parts)])
    part = (mixed(hashes, _PARTS_SALT + 1000 * turn) % parts[text].astype(np.uint64)).astype(np.int64)
    slot = first[text] + part
    value = mixed(hashes, _SUM_SALT)
    total = int(first[-1])
    # Halves are summed apart: each sum stays exact in a double.
    low = np.bincount(slot, (value & _U(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
    high = np.bincount(slot, (value >> _U(32)).astype(np.float64), total).astype(np.uint64)
    filled = np.bincount(slot, minlength=total) > 0
    owner = np.repeat(np.arange(len(parts)), parts)
    empty = np.bincount(owner[~filled], minlength=len(parts))
    loose = spare - 1 - empty
    listed = filled | ((loose < 0) & (turn == TURNS - 1))[owner]
    with np.errstate(over="ignore"):
        number = (np.arange(total) - first[owner]).astype(np.uint64)
        key = mixed(mixed(low + (high << _U(32)), _KEY_SALT) + number * _U(1_000_003) + size_class[owner].astype(np.uint64), _KEY_SALT)
    return key[listed], owner[listed], loose


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for start, stop in byte_slices(batch.column("text"), _SLICE_BYTES):
        own = batch.slice(start, stop - start)
        texts = [t.encode() for t in own.column("text").to_pylist()]
        yield own, *shingle_sets(texts, words)


def profiles(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """Packed part keys per slice (bucket from 0), and per slice (bucket -1) its documents.

    A document has doc_id, n (set size), same and same2 (set digest), alike (group hint), and the number of
    keys it can spare of its own class (loose) and of the next one (loose_next).  The owner of a part key is
    four times the document's place, plus 2 where the cut into parts suits it, plus 1 where the key is of its
    own class.
    """

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        steps = size_steps(percent)
        lists = pa.list_(pa.int64())
        names = ["slice", "bucket", "prints", "owners", *DOCUMENT]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[lists] * len(DOCUMENT)]
        for batch in batches:
            for own, hashes, text in _sets(batch, words):
                n = own.num_rows
                size = np.bincount(text, minlength=n)
                level = np.searchsorted(steps, np.maximum(size, 1), side="right") - 1
                filled = np.flatnonzero(size)
                same = np.zeros((2, n), dtype=np.uint64)
                alike = np.zeros(n, dtype=np.uint64)
                loose = np.zeros((2, n), dtype=np.int64)
                keys, owners = [], []
                if len(filled):
                    begins = (np.cumsum(size) - size)[filled]
                    for i, salt in enumerate((7, 8)):
                        same[i, filled] = np.add.reduceat(mixed(hashes, salt), begins)
                    # Two least hashes agree for most near copies and hardly ever by chance.
                    least = [np.minimum.reduceat(mixed(hashes, salt), begins) for salt in (11, 12)]
                    with np.errstate(over="ignore"):
                        alike[filled] = mixed(least[0] + _U(3) * least[1])
                for step in (0, 1):
                    # A class with one part links equal sets only, and these are one class already.
                    wanted = (size > 0) & (parts_of(level + step, percent)[0] > 1)
                    for turn in range(TURNS):
                        kept = wanted[text]
                        if not kept.any():
                            break
                        index, place = np.cumsum(wanted) - 1, np.flatnonzero(wanted)
                        key, owner, left = part_keys(hashes[kept], index[text[kept]], (level + step)[wanted], percent, turn)
                        loose[step, place] = np.maximum(left, 0)
                        keys.append(key)
                        owners.append(4 * place[owner] + 2 * (left >= 0)[owner] + (1 - step))
                        wanted[place[left >= 0]] = False
                number = (part << 32) + seq
                seq += 1
                listed = [own.column("doc_id").to_pylist(), size.tolist(), *(x.view(np.int64).tolist() for x in (same[0], same[1], alike)), *loose.tolist()]
                out = [(number, -1, None, None, *listed)]
                if keys:
                    out += [(*r, *[None] * len(DOCUMENT)) for r in packed_rows(number, np.concatenate(keys), np.concatenate(owners), buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        freed()

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lists = ", ".join(f"{c} array<long>" for c in DOCUMENT)
    return text.mapInArrow(profile, f"{PACKED_KINDS}, {lists}")


def grouped(classes: DataFrame, members: int) -> DataFrame:
    """Add ``grp``: classes with one hint share a group of about ``members``, larger ones are cut by hash."""
    many = classes.groupBy("alike").agg(F.ceil(F.count(F.lit(1)) / members).alias("__cuts")).where("__cuts > 1")
    part = F.pmod(F.xxhash64("rep"), F.coalesce("__cuts", F.lit(1)))
    return classes.join(many, "alike", "left").withColumn("grp", F.xxhash64("alike", part)).drop("__cuts")


def union_sketch(union: np.ndarray) -> bytes:
    """Counts of a union's shingles per hash cell, one cell for one to two shingles; empty where a count needs more than a byte."""
    cells = 1 << max(4, (len(union) // 2).bit_length())
    counts = np.bincount((mixed(union.view(np.uint64), _CELL_SALT) & _U(cells - 1)).astype(np.int64), minlength=cells)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def may_link(sketch_a: bytes, least_a: int, sketch_b: bytes, least_b: int, percent: int) -> bool:
    """False only if no member of one group can link to one of the other.

    Members share no more than the unions do, and these no more than the smaller counts of each cell.
    A link takes percent / (100 + percent) of both sizes together; ``least`` is the smallest member.
    """
    if not sketch_a or not sketch_b:
        return True
    a, b = sorted((np.frombuffer(x, np.uint8) for x in (sketch_a, sketch_b)), key=len)
    shared = int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0, dtype=np.int64)).sum(dtype=np.int64))
    return shared * (100 + percent) >= percent * (least_a + least_b)


def group_rows(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(grp, reps, union, marks, least, sketch): the matrix row of each wanted group.

    ``wanted`` has (rep, grp).  Sets are made from the texts again instead of being kept for all documents.
    ``marks`` holds one bit per member and union shingle; ``least`` and ``sketch`` serve may_link().
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, hashes, text in _sets(batch, words):
                yield pa.RecordBatch.from_arrays(
                    [own.column("grp"), own.column("rep"), _lists(hashes, text, own.num_rows)], names=["grp", "rep", "tokens"]
                )
        freed()

    def unite(key, table):
        tokens = table.column("tokens").combine_chunks()
        flat = np.asarray(tokens.flatten())
        union, place = np.unique(flat, return_inverse=True)
        marks = np.zeros((table.num_rows, len(union)), dtype=bool)
        marks[np.repeat(np.arange(table.num_rows), np.asarray(pc.list_value_length(tokens))), place] = True
        return pa.table(
            {
                "grp": pa.array([key[0].as_py()], pa.int64()),
                "reps": pa.array([table.column("rep").to_pylist()], pa.list_(pa.int64())),
                "union": pa.array([union], pa.list_(pa.int64())),
                "marks": pa.array([np.packbits(marks, axis=1).tobytes()], pa.binary()),
                "least": pa.array([int(pc.min(pc.list_value_length(tokens)).as_py())], pa.int64()),
                "sketch": pa.array([union_sketch(union)], pa.binary()),
            }
        )

    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("rep"), F.coalesce("text", F.lit("")).alias("text"))
    once = texts.join(wanted, "rep").select("grp", "rep", "text").mapInArrow(sets, "grp long, rep long, tokens array<long>")
    kinds = "grp long, reps array<long>, union array<long>, marks binary, least long, sketch binary"
    return once.groupBy("grp").applyInArrow(unite, kinds)


def rare_shingles(groups: DataFrame, percent: int) -> DataFrame:
    """(grp, rep, key, rest, n): of each member's n shingles the rarest ones that another of the groups has too.

    Shingles have one order, by the number of groups that have them.  Linked sets share percent of either
    or more, so the first shingle that they share has as many behind it, itself included (``rest``): it is
    among the first n - ceil(percent * n / 100) + 1 of both.
    """

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for i in range(batch.num_rows):
                reps, union = (np.asarray(batch.column(c)[i].values) for c in ("reps", "union"))
                bits = np.frombuffer(batch.column("marks")[i].as_buffer(), np.uint8).reshape(len(reps), -1)
                shared = batch.column("shared")[i].values
                many = np.ones(len(union), dtype=np.int64)
                many[np.searchsorted(union, np.asarray(shared.field("key")))] = np.asarray(shared.field("many"))
                order = np.lexsort((union, many))
                for rep, marks in zip(reps.tolist(), bits):
                    own = order[np.unpackbits(marks, count=len(union))[order] > 0]
                    first = own[: len(own) + percent * len(own) // -100 + 1]
                    place = np.flatnonzero(many[first] > 1)
                    grp, whole = batch.column("grp")[i].as_py(), len(own)
                    out.append((np.full(len(place), grp), np.full(len(place), rep), union[first[place]], whole - place, np.full(len(place), whole)))
            columns = [np.concatenate(x) for x in zip(*out)] or [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["grp", "rep", "key", "rest", "n"])
        freed()

    shingles = groups.select("grp", F.explode("union").alias("key"))
    common = shingles.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    shared = shingles.join(common, "key").groupBy("grp").agg(F.collect_list(F.struct("key", "many")).alias("shared"))
    return groups.select("grp", "reps", "union", "marks").join(shared, "grp").mapInArrow(rarest, "grp long, rep long, key long, rest long, n long")


def _group(batch: pa.RecordBatch, row: int, suffix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(reps, union, marks) of one side of a pair, as views of the batch where possible."""
    reps, union = (np.asarray(batch.column(c + suffix)[row].values) for c in ("reps", "union"))
    bits = np.frombuffer(batch.column("marks" + suffix)[row].as_buffer(), np.uint8).reshape(len(reps), -1)
    return reps, union, np.unpackbits(bits, axis=1, count=len(union))


def opened_links(a: tuple, b: tuple, percent: int) -> list[tuple[int, int]]:
    """Links between the members of two groups, bounded by the union before a group is opened."""
    reps_a, union_a, marks_a = a
    reps_b, union_b, marks_b = b
    place = np.minimum(np.searchsorted(union_b, union_a), len(union_b) - 1)  # unions are sorted
    at_a = np.flatnonzero(union_b[place] == union_a)
    at_b = place[at_a]
    size_a, size_b = marks_a.sum(axis=1, dtype=np.int64), marks_b.sum(axis=1, dtype=np.int64)
    # No set of b shares more with a query than the union does; a link needs percent of the query.
    queries = np.flatnonzero(100 * marks_a[:, at_a].sum(axis=1, dtype=np.int64) >= percent * size_a)
    answers = np.flatnonzero(100 * marks_b[:, at_b].sum(axis=1, dtype=np.int64) >= percent * size_b)
    if not len(queries) or not len(answers):
        return []
    exact = np.float32 if len(at_a) < 1 << 24 else np.float64  # counts up to here stay whole numbers
    shared = (marks_a[np.ix_(queries, at_a)].astype(exact) @ marks_b[np.ix_(answers, at_b)].T.astype(exact)).astype(np.int64)
    union = size_a[queries][:, None] + size_b[answers][None, :] - shared
    x, y = np.nonzero(100 * shared >= percent * union)
    return list(zip(reps_a[queries[x]].tolist(), reps_b[answers[y]].tolist()))


def spanning(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Enough of the links to keep the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def qualifying(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs of groups (g, h) that may hold a link, by the sketches of their unions alone."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c + s).to_pylist() for s in "gh" for c in ("sketch_", "least_")]
            kept = [may_link(*row, percent) for row in zip(*sides)]
            yield batch.select(["g", "h"]).filter(pa.array(kept, pa.bool_()))

    def side(s: str) -> DataFrame:
        return groups.select(F.col("grp").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("sketch", "least")])

    return pairs.join(side("g"), "g").join(side("h"), "h").mapInArrow(bound, "g long, h long")


def links_between(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(src, dst): spanning links of each pair of groups (g, h); g = h compares a group with itself."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for i in range(batch.num_rows):
                out += spanning(opened_links(_group(batch, i, "_g"), _group(batch, i, "_h"), percent))
            out = [(a, b) for a, b in out if a != b]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["src", "dst"])
        freed()

    def side(s: str) -> DataFrame:
        return groups.select(F.col("grp").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("reps", "union", "marks")])

    return pairs.join(side("g"), "g").join(side("h"), "h").drop("g", "h").mapInArrow(compare, "src long, dst long")


def join_classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members, components): (doc_id, n, rep) of every document, and (node, component) of linked reps.

    A document without shingles, or without an id, has no rep.
    """
    # A word takes about 6 bytes; a set of n shingles has n * 2 * (100 - percent) / (100 + percent) parts, twice.
    per_key = max(1, 6 * (100 + percent) // (5 * (100 - percent) + 1))
    slices = staged(profiles(docs, words, percent, bucket_count(text_bytes(docs), per_key)), "jaccard-slices")
    known = slices.where("bucket < 0").select("slice", F.posexplode(F.arrays_zip(*DOCUMENT)).alias("place", "d")).select("slice", "place", *[F.col("d")[f].alias(f) for f in DOCUMENT])
    sets = known.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    digest = ["n", "same", "same2"]
    first = sets.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.min("alike").alias("alike"))
    classes = staged(grouped(first, GROUP_MEMBERS), "jaccard-classes")
    members = known.select("doc_id", *digest).join(classes.select(*digest, "rep"), digest, "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")
    )
    # Keys of the larger set (own class) meet keys of the smaller one (own or next class); copies
    # of a class share all keys and count once.
    home = sets.join(classes.select(F.col("rep").alias("doc_id"), "grp"), "doc_id").select("slice", "place", "grp", "loose", "loose_next")
    found_keys = shared_keys(slices).select("slice", F.shiftright("owner", 2).cast("int").alias("place"), "key", (F.col("owner") % 2 == 1).alias("home"), (F.col("owner") % 4 > 1).alias("suits"), "many")
    # The keys that a document can spare are its most frequent ones, those of common passages.
    frequent = Window.partitionBy("slice", "place", "home", "suits").orderBy(F.desc("many"), "key")
    spared = F.when(F.col("home"), F.col("loose")).otherwise(F.col("loose_next"))
    telling = found_keys.join(home, ["slice", "place"]).withColumn("nth", F.row_number().over(frequent)).where(~F.col("suits") | (F.col("nth") > spared))
    parts = staged(telling.groupBy("key", "grp").agg(F.max("home").alias("home")), "jaccard-keys")
    least = parts.groupBy("key").agg(F.min("grp").alias("least"), F.count(F.lit(1)).alias("many"), F.max("home").alias("any")).where("many > 1 and any")
    shared = staged(parts.join(least.select("key", "least", "many"), "key"), "jaccard-parts")
    tied = shared.where("grp <> least").select(F.col("least").alias("g"), F.col("grp").alias("h"))
    alone = classes.groupBy("grp").count().where("count > 1").select(F.col("grp").alias("g"), F.col("grp").alias("h"))
    pairs = staged(tied.distinct(), "jaccard-pairs")
    wanted = pairs.select(F.col("g").alias("grp")).union(pairs.select("h")).union(alone.select("g")).distinct()
    groups = staged(group_rows(docs, classes.join(wanted, "grp").select("rep", "grp"), words), "jaccard-groups")
    opened = staged(qualifying(pairs, groups, percent).union(alone), "jaccard-opened")
    links = staged(links_between(opened, groups, percent), "jaccard-links")
    found = staged(components(links), "jaccard-found")

    # Keys with three groups or more: pairs of groups not yet tied to each other as a whole.
    whole = (
        classes.join(found, F.col("rep") == F.col("node"), "left")
        .groupBy("grp")
        .agg(F.min(F.coalesce("component", "rep")).alias("low"), F.max(F.coalesce("component", "rep")).alias("high"))
        .select("grp", F.when(F.col("low") == F.col("high"), F.col("low")).alias("comp"))
    )
    open_keys = shared.where("many > 2").join(whole, "grp")
    mixed_keys = open_keys.groupBy("key").agg(
        F.min(F.coalesce("comp", "grp")).alias("lo"), F.max(F.coalesce("comp", "grp")).alias("hi"), F.count(F.when(F.col("comp").isNull(), 1)).alias("split")
    ).where("lo <> hi or split > 0")
    # A link between components has both its groups here.  Variants of one text share part keys without
    # being linked, as many pairs as the square of their number; their rarest shingles tell them apart.
    # Stored, as each is read several times below: the plans would hold all that made them as often.
    wide = staged(open_keys.join(mixed_keys.select("key"), "key").select("grp").distinct(), "jaccard-wide")
    telling = rare_shingles(groups.join(wide, "grp"), percent).join(found, F.col("rep") == F.col("node"), "left")
    units = staged(telling.groupBy("key", F.coalesce("component", "rep").alias("comp"), "grp").agg(F.max("rest").alias("rest"), F.min("n").alias("least")), "jaccard-units")
    several = units.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    near = staged(units.join(several, "key"), "jaccard-rare")
    other = near.select("key", *[F.col(c).alias(f"{c}_h") for c in ("comp", "grp", "rest", "least")])
    # Neither side has more shingles from this one on than its rest; a link needs so many in common.
    enough = F.least("rest", "rest_h") * (100 + percent) >= percent * (F.col("least") + F.col("least_h"))
    more = (
        near.join(other, "key")
        .where((F.col("comp") < F.col("comp_h")) & (F.col("grp") != F.col("grp_h")) & enough)
        .select(F.least("grp", "grp_h").alias("g"), F.greatest("grp", "grp_h").alias("h")).distinct()
        .join(pairs, ["g", "h"], "left_anti")
    )
    opened = staged(qualifying(more, groups, percent), "jaccard-opened")
    late = staged(links_between(opened, groups, percent), "jaccard-late")
    if not late.isEmpty():
        found = components(links.union(late))
    return members, found


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Two documents link when 100 * shared >= percent * union of their shingle sets.  NULL and wordless
    texts have no shingles and are their own component; rows without an id keep a NULL component;
    repeated ids are compared row by row and share their number.  Other columns are ignored.
    """
    members, found = join_classes(docs.select("doc_id", "text"), words, percent)
    component = F.coalesce("component", "rep", "doc_id")
    return members.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def kept_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that have a smaller id in their component; all columns stay.

    Rows without an id stay, and so do all rows of a repeated id that is the least of its component.
    """
    marked = near_duplicates(docs, words, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(marked, F.col("doc_id") == F.col("__id"), "left_anti")
