"""Runs of words against a comparison of every stretch at every lag."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from creditloom.llm import runs


def words_of(text):
    return (text or "").encode().split()


def planted(doc_id, text):
    words = words_of(text)
    n = len(words)
    if doc_id is None or not n or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_runs(words):
    """All runs, each lag over the whole text."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        start = 0
        while start < n - q:
            stop = start
            while stop < n - q and words[stop] == words[stop + q]:
                stop += 1
            length = stop - start + q
            if length >= max(6, 4 * q):
                stretch = words[start : start + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            start = stop + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def expected(doc_id, text):
    words = planted(doc_id, text)
    found = plain_runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(),
    )


def answers(docs):
    return sorted((tuple(r)[:8] for r in runs.run_digests(docs).collect()), key=str)


def test_edge_documents(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answers(docs) == sorted((expected(*r) for r in rows), key=str)
    assert runs.run_digests(no_docs).count() == 0
    assert [f.name for f in runs.run_digests(docs).schema.fields] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]


def repetitive_text(rng):
    """Words of a small alphabet with repeated stretches, some inside others, and odd white space."""
    words = [rng.choice("abc") for _ in range(rng.randrange(40))]
    for _ in range(rng.randrange(4)):
        period = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 5, 15, 16, 17, 18, 24, 31, 32, 33, 40, 64, 65]))]
        if rng.random() < 0.4:
            period += [rng.choice("ab")] * rng.randrange(30)
        many = rng.choice([2.5, 3.9, 4, 4.0, 4.3, 6])
        words += [period[i % len(period)] for i in range(int(len(period) * many) + rng.randrange(2))]
        words += [rng.choice("abcdefgh") for _ in range(rng.randrange(20))]
    return "".join(w + rng.choice([" ", "\n", " \t", "\x0b"]) for w in words)


def test_repetitive_documents(spark):
    rng = random.Random(5)
    rows = [(i, repetitive_text(rng)) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answers(docs) == sorted((expected(*r) for r in rows), key=str)


def test_long_periods_lose_no_run():
    """Every period of several scales, four periods long, in one array of documents."""
    rng = np.random.default_rng(7)
    for low in (16, 64, 256):
        for letters in (2, 50):
            words, ends, wanted = [], [], []
            for period in range(low + 1, 2 * low + 1, max(1, low // 16)):
                before = rng.integers(0, letters, 30).tolist()
                unit = rng.integers(0, letters, period).tolist()
                words += before + [unit[i % period] for i in range(4 * period)]
                wanted.append((period, len(words)))
                words.append(1000 + len(ends))
                ends.append(len(words) - 1)
            found = list(runs._long_runs(np.array(words), np.array(ends)))
            for period, stop in wanted:
                assert any(q == period and s <= stop - 4 * q and s + n >= stop for s, n, q in found), (low, letters, period)


def test_a_long_text(spark):
    text = " ".join(["same"] * 150_000) + " " + " ".join(str(i % 30_011) for i in range(150_000)) + " end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = runs.collapse_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(0, 150_000, 1), (150_000, 150_000, 30_011)]
    assert row.collapsed.decode() == "same " + " ".join(map(str, range(30_011))) + " end"


def test_general_interface_has_spans(spark):
    docs = spark.createDataFrame([("1", "x a b a b a b a b y")], "doc_id string, text string")
    row = runs.collapse_runs(docs).select("runs", F.col("collapsed").cast("string").alias("c")).first()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2)] and row.c == "x a b y"
