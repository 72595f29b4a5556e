"""Anchors of many texts at once, and texts that meet by short pieces only."""

import random

import numpy as np
import pyarrow as pa

from creditloom.llm import packed, suffixes


def test_short_pieces_in_common_make_no_segments(spark, monkeypatch):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    piece, long = noise(20), noise(70)
    rows = [(i, "".join(noise(60) + piece for _ in range(8))) for i in range(60)]
    rows += [(100 + i, noise(60) + long + noise(60)) for i in range(2)]
    made, staged = {}, suffixes.staged
    monkeypatch.setattr(suffixes, "staged", lambda df, name: made.setdefault(name, staged(df, name)))
    found = {r["doc_id"]: r["n_removed"] for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: n for i, n in found.items() if n} == {101: 70}
    # 480 strings with the piece were brought together before, although none of 50 bytes is in two texts.
    assert {r["doc_id"] for r in made["suffix-segments"].collect()} == {100, 101}


def test_runs_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(9)
    texts = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in (0, 49, 50, 51, 0, 400, 3, 1200, 90, 0)]
    for least in (50, 20, 16):
        for block in (64, 1 << 14):
            monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
            for held in (pa.array(texts, pa.binary()), pa.array([b"x" * 70, *texts], pa.large_binary()).slice(1)):
                row, start, n, prints = suffixes.anchor_runs(held, least)
                starts = [(r, s + k, h) for r, s, m, h in zip(row.tolist(), start.tolist(), n.tolist(), prints.tolist()) for k in range(m)]
                assert [x[:2] for x in starts] == [(r, s) for r, t in enumerate(texts) for s in range(len(t) - least + 1)]
                anchor = {}
                for r, s, h in starts:  # equal strings have equal anchors
                    assert anchor.setdefault(texts[r][s : s + least], h) == h
    assert [len(x) for x in suffixes.anchor_runs(pa.array([], pa.binary()), 50)] == [0] * 4
    assert [len(x) for x in suffixes.anchor_runs(pa.array([b"", b""], pa.binary()), 50)] == [0] * 4


def test_pairs_are_packed_once():
    rng = np.random.default_rng(10)
    for buckets in (1, 7, 1 << 29):
        keys = rng.integers(0, 1 << 63, 300, dtype=np.uint64)[rng.integers(0, 300, 2000)]
        owners = rng.integers(0, 40, 2000)
        rows = packed.packed_once(5, keys, owners, buckets)
        got = [(r[1] << 32 | p, o) for r in rows for p, o in zip(np.frombuffer(r[2], np.uint32).tolist(), np.frombuffer(r[3], np.uint32).tolist())]
        assert got == sorted(set(zip(packed.packed_keys(keys, buckets).tolist(), owners.tolist())))
        assert [r[0] for r in rows] == [5] * len(rows)
    assert packed.packed_once(5, np.zeros(0, np.uint64), np.zeros(0, np.int64), 7) == []
