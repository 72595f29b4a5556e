"""The order of suffixes and the stored steps of the repeats."""

import numpy as np

from creditloom.llm import suffixes
from tests.llm.test_disk import shuffle_files


def test_suffix_order_is_that_of_the_strings():
    rng = np.random.default_rng(5)
    for letters, longest in ((2, 40), (5, 90), (256, 30)):
        strings = [bytes(rng.integers(0, letters, rng.integers(1, longest)).astype(np.uint8)) for _ in range(60)]
        strings += strings[:20] + [b"\0" * 70, b"\xff" * 70]
        text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int16) + 1, 0) for s in strings]).astype(np.int16)
        order = suffixes.suffix_order(text).tolist()
        ends = np.flatnonzero(text == 0)
        ordered = [text[i : ends[np.searchsorted(ends, i)] + 1].tolist() for i in order]
        assert sorted(order) == [*range(len(text))] and ordered == sorted(ordered)


def test_shuffles_of_the_steps_are_not_kept_together(spark):
    part = "The same passage of more than fifty bytes stands in every second one of these documents. "
    rows = [(i, part + f"{i} " * 30 if i % 2 else f"{i * 7} " * 30) for i in range(200)]
    before = shuffle_files(spark)
    found = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert shuffle_files(spark) <= before
    got = {r["doc_id"]: r for r in found.collect()}
    assert [i for i in got if got[i]["n_removed"] >= len(part)] and got[1]["n_removed"] == 0
    steps = found._jdf.queryExecution().optimizedPlan().toString()
    assert "anchor" not in steps  # segments and anchors were met before, in writes of their own


def test_wide_keys_are_sorted_by_halves_and_keep_their_order():
    rng = np.random.default_rng(6)
    for key_bits in (3, 40, 62):
        key = rng.integers(0, 1 << key_bits, 5000) >> rng.integers(0, key_bits, 5000) << 1 >> 1
        ranked, order = suffixes._sorted_keys(key, key_bits, 13)
        assert order.tolist() == np.argsort(key, kind="stable").tolist() and ranked.tolist() == sorted(key.tolist())


def test_intervals_reach_the_length_in_a_few_extensions(monkeypatch):
    rng = np.random.default_rng(7)
    strings = [bytes(rng.integers(97, 99, rng.integers(50, 120)).astype(np.uint8)) for _ in range(200)]
    strings += [strings[i][: int(rng.integers(50, len(strings[i]) + 1))] for i in range(100)]
    text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int16) + 1, 0) for s in strings]).astype(np.int16)
    order = suffixes.suffix_order(text)
    rounds, cumsum = [], np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda *a, **k: rounds.append(1) or cumsum(*a, **k))
    for least in (1, 2, 3, 31, 32, 33, 50):
        rounds.clear()
        interval = suffixes.equal_prefix_intervals(text, order, least)
        assert len(rounds) <= 1 + least.bit_length()
        raw = text.tobytes()
        prefix = [raw[2 * i : 2 * (i + least)] for i in order.tolist()]
        whole = [0 not in text[i : i + least] and i + least <= len(text) for i in order.tolist()]
        for a in range(1, len(order)):
            same = whole[a] and whole[a - 1] and prefix[a] == prefix[a - 1]
            assert same == (interval[a] == interval[a - 1])
