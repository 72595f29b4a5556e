"""Runs of words: stretches that repeat with a period, found with multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` words long, that cannot
be extended with period q.  Periods up to SHORT are found by comparing the words with themselves at
every such lag.  Longer periods are taken in scales (low, 2 low].  There every position has a hash of
the ``low / 2`` words from it on; positions whose hash came up at most ``low / 6`` words before lie in
a finer repetition and are left out.  Of the others the minima of all windows of ``low`` words are
kept.  Inside a run everything but its edges repeats at the distance q, window minima too, and

    4 q >= q + q + low + low / 2 + low / 6

leaves room for a window, the same window one period on, and a whole period of places for it, so each
run holds two equal minima at the distance q.  Equal minima of a scale are hence paired when their
distance is in the scale, and each pair is extended word by word.  Equal hashes of different words
only add a pair that does not extend.

A document is worked on by one task with arrays of a few bytes per byte of its text.  Defined cases:
a NULL or empty text has no words and no runs; a NULL id keeps its text as it is; repeated rows give
repeated results; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, utf8_bytes

SHORT = 16
LEAST_WORDS, LEAST_PERIODS = 6, 4
_SLICE_BYTES = 4 << 20
_NO_HASH = np.uint64(0xFFFFFFFFFFFFFFFF)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_KINDS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of twice the width; the last word of all is a document end and makes its hashes unique."""
    later = np.zeros_like(hashes)
    later[: len(hashes) - width] = hashes[width:]
    return _mixed(hashes, later)


def _sliding(values: np.ndarray, width: int, best, forward: bool) -> np.ndarray:
    """Best of the ``width`` (a power of two) values from each position on, or up to it."""
    done = 1
    while done < width:
        other = values.copy()
        if done < len(values):
            if forward:
                other[:-done] = values[done:]
            else:
                other[done:] = values[:-done]
        values = best(values, other)
        done *= 2
    return values


def _window_minima(hashes: np.ndarray, low: int) -> np.ndarray:
    """Positions that hold the least hash of a window of ``low`` positions outside finer repetitions."""
    order = np.argsort(hashes, kind="stable")
    near = (hashes[order[1:]] == hashes[order[:-1]]) & (np.diff(order) <= low // 6)
    values = hashes.copy()
    values[order[1:][near]] = _NO_HASH
    least = _sliding(values, low, np.minimum, forward=True)
    kept = _sliding(least, low, np.maximum, forward=False)
    return np.flatnonzero((kept == values) & (values != _NO_HASH))


def _seeds(hashes: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of equal window minima at a distance in (low, 2 low]."""
    minima = _window_minima(hashes, low)
    minima = minima[np.argsort(hashes[minima], kind="stable")]
    values = hashes[minima]
    places, lags, step = [], [], 1
    while step < len(minima):
        lag = minima[step:] - minima[:-step]
        close = (values[step:] == values[:-step]) & (lag <= 2 * low)
        if not close.any():
            break
        wanted = close & (lag > low)
        places.append(minima[:-step][wanted])
        lags.append(lag[wanted])
        step += 1
    return (np.concatenate(places), np.concatenate(lags)) if places else (minima[:0], minima[:0])


def _agreement(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """First and last-but-one position of the stretch around ``at`` whose words recur ``lag`` later."""
    stop, block = at, 64
    while stop < len(words) - lag:
        size = min(block, len(words) - lag - stop)
        miss = np.flatnonzero(words[stop : stop + size] != words[stop + lag : stop + lag + size])
        if len(miss):
            stop += int(miss[0])
            break
        stop, block = stop + size, block * 2
    start, block = at, 64
    while start > 0:
        size = min(block, start)
        miss = np.flatnonzero(words[start - size : start] != words[start - size + lag : start + lag])
        if len(miss):
            start -= size - 1 - int(miss[-1])
            break
        start, block = start - size, block * 2
    return start, stop


def _is_smallest(words: np.ndarray, start: int, length: int, period: int) -> bool:
    """A stretch of two periods has a smaller one only if that divides ``period``."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = period // factor
            if np.array_equal(words[start : start + length - part], words[start + part : start + length]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def _short_runs(words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for lag in range(1, min(SHORT, len(words) - 1) + 1):
        same = np.flatnonzero(words[lag:] == words[:-lag])
        if not len(same):
            continue
        cuts = np.flatnonzero(np.diff(same) != 1)
        starts = same[np.concatenate([[0], cuts + 1])]
        lengths = same[np.concatenate([cuts, [len(same) - 1]])] + 1 - starts + lag
        long = lengths >= _least_length(lag)
        for start, length in zip(starts[long].tolist(), lengths[long].tolist()):
            yield start, length, lag


def _long_runs(words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``ends`` are the positions of the document ends, the last of them the last position."""
    sizes = np.diff(ends, prepend=-1)
    low, width = SHORT, 1
    hashes = _mixed(words.astype(np.uint64), np.uint64(0x94D049BB133111EB))
    place = np.arange(len(words))
    while True:
        long = sizes > LEAST_PERIODS * (low + 1)  # a document end counts as a word here
        if not long.any():
            return
        if not long.all():
            inside = np.repeat(long, sizes)
            hashes, place, sizes = hashes[inside], place[inside], sizes[long]
        while width < low // 2:
            hashes, width = _doubled(hashes, width), width * 2
        at, lags = _seeds(hashes, low)
        order = np.lexsort((at, lags))
        seen_lag, seen_stop = 0, -1
        for start, lag in zip(place[at[order]].tolist(), lags[order].tolist()):
            if lag == seen_lag and start < seen_stop:
                continue
            first, stop = _agreement(words, start, lag)
            seen_lag, seen_stop = lag, stop
            if stop - first + lag >= _least_length(lag):
                yield first, stop - first + lag, lag
        low *= 2


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one line end behind each text, and the position behind each text."""
    parts = texts.to_pylist()
    data = np.frombuffer(b"".join(part + b"\n" for part in parts), np.uint8)
    return data, np.cumsum([len(part) + 1 for part in parts], dtype=np.int64)


def _collapsed_slice(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    data, text_stops = _joined(texts)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.diff(space.view(np.int8), prepend=1)
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    bytes_of_words = pa.py_buffer(data[~space])
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), bytes_of_words]
    ).dictionary_encode()
    # Each document is followed by an end of its own that equals no word.
    word_stops = np.searchsorted(starts, text_stops)
    counts = np.diff(word_stops, prepend=0)
    ends = word_stops + np.arange(len(counts))
    words = np.empty(len(starts) + len(counts), np.int64)
    is_end = np.zeros(len(words), bool)
    is_end[ends] = True
    words[~is_end] = spelled.indices.to_numpy()
    words[ends] = len(spelled.dictionary) + np.arange(len(counts))

    found = {*_short_runs(words), *_long_runs(words, ends)}
    runs = sorted((s, n, q) for s, n, q in found if _is_smallest(words, s, n, q))
    runs = sorted(runs, key=lambda run: (run[0], run[2]))
    owner = np.searchsorted(ends, np.array([s for s, _, _ in runs], np.int64))
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    kept = kept[~is_end]
    columns = np.array(runs, np.int64).reshape(-1, 3)
    columns[:, 0] -= np.concatenate([[0], ends + 1])[owner]
    listed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(c) for c in columns.T], fields=list(_RUN)),
    )

    # A kept word takes the white space byte behind it along.
    change = np.zeros(len(data) + 1, np.int8)
    change[starts[kept]] += 1
    change[stops[kept] + 1] -= 1
    stay = np.cumsum(change[:-1], dtype=np.int8).view(bool)
    left = np.where(space, np.uint8(32), data)[stay].tobytes()
    stay_stops = np.cumsum(np.bincount(np.searchsorted(text_stops, starts[kept], side="right"),
                                       weights=(stops - starts)[kept] + 1, minlength=len(counts))).astype(np.int64)
    texts_left = [left[a : max(a, b - 1)] for a, b in zip([0, *stay_stops[:-1].tolist()], stay_stops.tolist())]
    return pa.RecordBatch.from_arrays(
        [ids, listed, pa.array(texts_left, pa.binary())], names=["doc_id", "runs", "collapsed"]
    )


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): all runs by start and period, and the words outside later periods.

    ``collapsed`` holds, joined by one space in UTF-8, every word that no run contains after the
    run's first period.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for start, stop in byte_slices(texts, _SLICE_BYTES):
                yield _collapsed_slice(ids[start:stop], texts[start:stop])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8_bytes("text").alias("text"))
    return rows.mapInArrow(collapse, RUN_KINDS)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the tail of one document in ten repeats, as the contract of op11 asks.

    With h the CRC-32 of the decimal id and g = h div 10, a text of n words with h mod 10 = 0 has its
    words from a = g mod n on replaced by repetitions of the first 1 + (n - a) div (3 + g mod 8) of them.
    """
    number = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(number % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = docs.select("doc_id", "text", F.floor(number / 10).alias("g"), words.alias("words"))
    n = F.size("words").cast("long")
    first = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    period = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))

    def word(i: Column) -> Column:
        source = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("words", source.cast("int"))

    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " ")
    return first.withColumn("p", period).select(
        "doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text")
    )


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the run with most periods and digests of all of them."""
    found = collapse_runs(with_planted_repeats(docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))

    def better(one: Column, two: Column) -> Column:
        # The runs come by start and period, so the earlier of two equal ones stays.
        return F.when(two["length"] * one["period"] > one["length"] * two["period"], two).otherwise(one)

    runs = F.col("runs")
    best = F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), better)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
