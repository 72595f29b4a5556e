"""Vector codes against plain Python loops."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

from creditloom.llm import lloyd

KINDS = "vec_id long, embedding array<float>, label int, code string, error int, part int"


def plain_codes(rows):
    kept = [(i, [float(x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16)
    full = [[math.floor(256 * x) for x in v] + [0] * (16 * width - len(v)) for _, v, _ in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(16)] for v in full]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:64]
    books = [[cut[r][p] for r in order] for p in range(16)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            members = defaultdict(list)
            for v in cut:
                members[nearest(v[p], books[p])[1]].append(v[p])
            for n, parts in members.items():
                books[p][n] = tuple(sum(c) // len(parts) for c in zip(*parts))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, errors = [], defaultdict(int)
    for (i, _, label), v in zip(kept, cut):
        hits = [nearest(v[p], books[p]) for p in range(16)]
        error = sum(d for d, _ in hits)
        errors[label] += error
        found.append((i, "".join(f"{n:02x}" for _, n in hits), error, label))
    return sorted(((i, c, e, errors[label], digest) for i, c, e, label in found), key=str)


def answers(spark, rows, slices=3):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KINDS).repartition(slices)
    result = lloyd.compressed_vectors(table)
    assert result.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in result.collect()), key=str)


def vectors(count, length, seed, hot=0.0):
    rng = random.Random(seed)
    common = [rng.randrange(-64, 64) / 128 for _ in range(length)]
    return [(i, common if rng.random() < hot else [rng.randrange(-300, 300) / 128 for _ in range(length)],
             None if i % 7 == 0 else i % 3) for i in range(count)]


def test_equals_plain_loops_with_a_hot_vector_and_ties(spark):
    rows = vectors(300, 32, 1, hot=0.4)
    assert answers(spark, rows) == plain_codes(rows)


def test_edge_rows(spark):
    rows = vectors(80, 32, 2) + [
        (None, [0.5] * 32, 1), (100, None, 1), (101, [0.5] * 31 + [None], 1), (102, [float("nan")] * 32, 1),
        (103, [float("-inf")] + [0.0] * 31, None), (104, [0.25] * 20, 2), (105, [], None),
        (3, [0.125] * 32, 0), (3, [0.125] * 32, 0), (106, [-0.001] * 32, 1),
    ]
    assert answers(spark, rows) == plain_codes(rows)


def test_few_rows_odd_lengths_and_no_rows(spark):
    for rows in ([(5, [0.1, 0.2, 0.3], 1), (4, [0.3], 1)], [(1, [], None)], [(1, None, 1)], []):
        assert answers(spark, rows) == plain_codes(rows)


def test_salts_spread_an_entry(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "OWNER_ROWS", 50)
    rows = vectors(300, 16, 3, hot=0.6)
    assert answers(spark, rows) == plain_codes(rows)


def test_only_parts_that_change_move(spark):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in vectors(200, 16, 4)], KINDS)
    usable = lloyd.usable_vectors(table)
    lead = usable.orderBy("vec_id").limit(64).collect()
    import numpy as np

    books = np.floor(256 * np.array([r.embedding for r in lead])).astype(np.int64).reshape(64, 16, 1).transpose(1, 0, 2)
    members = lloyd.first_members(usable, books, 1)
    assert members.count() == 200 * 16
    assert lloyd.look_again(members, books).where("moved").count() == 0
    assert 0 < lloyd.look_again(members, lloyd.updated_books(members, books)).where("moved").count() < 200 * 16
