"""Bounds that save work never lose a result."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from creditloom.llm import ann, jaccard


def plain_links(sets, percent):
    return {
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    }


def test_union_sketches_never_refuse_a_link():
    draw = np.random.default_rng(5)
    for size in (1, 2, 7, 40, 300, 5000):
        base = draw.integers(-(2**62), 2**62, size)
        for percent in (80, 90):
            for changed in {0, 1, size // 20, size // 12, size // 9, size // 4, size}:
                other = np.concatenate([base[changed:], draw.integers(-(2**62), 2**62, changed + size // 50)])
                extra = draw.integers(-(2**62), 2**62, size // 3)  # further members of the group
                a, b, wide = (np.unique(x) for x in (base, other, np.concatenate([other, extra])))
                shared = len(np.intersect1d(a, b))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    for union in (b, wide):
                        one, two = jaccard.union_sketch(a), jaccard.union_sketch(union)
                        assert jaccard.may_link(one, len(a), two, len(b), percent)
                        assert jaccard.may_link(two, len(b), one, len(a), percent)
    far = [jaccard.union_sketch(np.unique(draw.integers(-(2**62), 2**62, 300))) for _ in range(2)]
    assert not jaccard.may_link(far[0], 300, far[1], 300, 80)
    assert jaccard.may_link(b"", 1, far[0], 300, 80)


def kept_keys(sets, percent, many=None):
    """Per set the keys of both classes; with ``many`` without the most frequent ones that it can spare."""
    steps, found = jaccard.size_steps(percent), []
    for own in sets:
        level, listed = int(np.searchsorted(steps, len(own), side="right")) - 1, set()
        for step in (0, 1):
            if jaccard.parts_of(np.array([level + step]), percent)[0][0] < 2:
                continue
            for turn in range(jaccard.TURNS):
                keys, _, loose = jaccard.part_keys(own, np.zeros(len(own), np.int64), np.array([level + step]), percent, turn)
                keys = keys.tolist()
                if many is not None and loose[0] > 0:
                    keys = sorted(keys, key=lambda k: (-many[k], k))[int(loose[0]) :]
                listed |= {(k, step) for k in keys}
                if loose[0] >= 0:
                    break
        found.append(listed)
    return found


def test_linked_sets_keep_a_key_in_common_and_strangers_have_none():
    draw = np.random.default_rng(8)
    for percent in (80, 90):
        sets = [np.unique(draw.integers(0, 2**63, int(draw.integers(200, 420)), dtype=np.uint64)) for _ in range(150)]
        whole = kept_keys(sets, percent)
        assert sum(map(len, whole)) == len({k for x in whole for k, _ in x})  # also where parts are empty
        passage = draw.integers(0, 2**63, 60, dtype=np.uint64)
        pairs = []
        for n in [*range(1, 40), *draw.integers(40, 900, 150).tolist()]:
            base = np.union1d(draw.integers(0, 2**63, n, dtype=np.uint64), passage[: n // 5])
            most = int(len(base) * (100 - percent) / 100)
            other = np.unique(np.concatenate([base[most // 2 :], draw.integers(0, 2**63, most // 3, dtype=np.uint64)]))
            shared = len(np.intersect1d(base, other))
            if 100 * shared >= percent * (len(base) + len(other) - shared):
                pairs.append((base, other))
        flat = [x for pair in pairs for x in pair]
        many = Counter(k for x in kept_keys(flat, percent) for k, _ in x)
        kept = kept_keys(flat, percent, many)
        assert len(pairs) > 50 and sum(map(len, kept)) < sum(map(len, kept_keys(flat, percent)))
        for a, b, x, y in zip(flat[::2], flat[1::2], kept[::2], kept[1::2]):
            single = jaccard.parts_of(np.searchsorted(jaccard.size_steps(percent), [max(len(a), len(b))], side="right") - 1, percent)[0][0] < 2
            assert single or {k for k, _ in x} & {k for k, _ in y}


def test_documents_with_shared_passages_link_as_in_brute_force(spark):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    passages = [pick.choices(words, k=60) for _ in range(4)]
    texts = []
    for i in range(160):
        own = pick.choices(words, k=pick.randint(30, 160))
        texts.append(own[:20] + passages[i % 4] + own[20:])
    for i in range(60):
        copy = list(texts[pick.randrange(100)])
        for _ in range(pick.randint(0, 6)):
            copy[pick.randrange(len(copy))] = pick.choice(words)
        texts.append(copy)
    for n, percent in ((5, 80), (3, 90)):
        sets = [{tuple(t[i : i + n]) for i in range(len(t) - n + 1)} for t in texts]
        root = list(range(len(texts)))
        changed = True
        links = plain_links(sets, percent)
        while changed:
            changed = False
            for i, j in links:
                low = min(root[i], root[j])
                changed |= root[i] != low or root[j] != low
                root[i] = root[j] = low
        df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df, n, percent).collect()}
        assert [got[i] for i in range(len(texts))] == root


def test_score_bound_loses_no_neighbour(spark, monkeypatch):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(1500, 8)).astype(np.float32)
    x[700:760] = x[10]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    with_bound = sorted(map(tuple, ann.search(df, every=20, k=20).collect()))
    monkeypatch.setattr(ann, "FIRST_LISTS", 10_000)
    assert with_bound == sorted(map(tuple, ann.search(df, every=20, k=20).collect()))
    monkeypatch.setattr(ann, "FIRST_LISTS", 1)
    assert with_bound == sorted(map(tuple, ann.search(df, every=20, k=20).collect()))
    assert len(with_bound) == 75 * 20
    assert ann.search(df.where(F.col("vec_id") < 12), every=5, k=20).count() == 3 * 11


def test_variants_of_one_text_meet_by_their_rarest_shingles_only(spark, monkeypatch):
    pick = random.Random(12)
    words = [f"w{i}" for i in range(30_000)]
    base = pick.choices(words, k=400)
    texts = []
    for _ in range(70):  # alike, not linked
        copy = list(base)
        for place in pick.sample(range(400), pick.randint(14, 26)):
            copy[place] = pick.choice(words)
        texts.append(copy)
    for i in range(6):  # linked to one of them
        copy = list(texts[7 * i])
        for place in pick.sample(range(400), 5):
            copy[place] = pick.choice(words)
        texts.append(copy)
    asked, whole = [], jaccard.qualifying
    monkeypatch.setattr(jaccard, "qualifying", lambda pairs, *a: (asked.append(pairs.count()), whole(pairs, *a))[1])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df, 5, 80).collect()}
    links = plain_links([{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts], 80)
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert [got[i] for i in range(len(texts))] == root
    assert len(links) < 100 and len(asked) == 2 and asked[1] < 100  # of 2,850 pairs


def test_linked_sets_share_a_rare_shingle_with_enough_behind_it(spark):
    draw = np.random.default_rng(21)
    common, sets = np.arange(40), []
    for n in (1, 2, 3, 9, 10, 40, 200):
        for changed in {0, n // 12, n // 9}:
            first = np.union1d(draw.integers(100, 10**9, n), common[: n // 3])
            second = np.union1d(first[changed:], draw.integers(100, 10**9, changed // 2))
            sets += [first.tolist(), second.tolist()]
    rows = []
    for g in range(0, len(sets), 3):  # three members a group
        union = np.unique(np.concatenate(sets[g : g + 3]))
        marks = np.array([np.isin(union, s) for s in sets[g : g + 3]])
        rows.append((g, list(range(g, min(g + 3, len(sets)))), union.tolist(), bytearray(np.packbits(marks, axis=1).tobytes())))
    groups = spark.createDataFrame(rows, "grp long, reps array<long>, union array<long>, marks binary")
    for percent in (80, 90):
        rest = {}
        for r in jaccard.rare_shingles(groups, percent).collect():
            assert r["n"] == len(sets[r["rep"]]) and r["key"] in sets[r["rep"]] and r["grp"] == r["rep"] // 3 * 3
            rest[r["rep"], r["key"]] = r["rest"]
        assert len(rest) < sum(map(len, sets)) / 3
        for i, j in plain_links([set(s) for s in sets], percent):
            if i // 3 != j // 3:
                both = [min(rest[i, k], rest[j, k]) for k in set(sets[i]) & set(sets[j]) if (i, k) in rest and (j, k) in rest]
                assert both and max(both) * (100 + percent) >= percent * (len(sets[i]) + len(sets[j]))
