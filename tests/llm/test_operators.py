"""Every operator against a plain version on small tables with odd rows."""

import base64
import hashlib
import itertools
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from creditloom.llm import ann, bpe, jaccard, mixing, neardup_vectors, pii, quality, sharding, suffixes, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_warc_records(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/ b", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 200_000), (5, "u", "é" * 200_000), (None, "u", "no id")],
        "page_id long, url string, html string",
    )
    got = {r["page_id"]: r for r in rows(warc.record_summary(warc.archive_pages(pages)))}
    assert set(got) == {1, 2, 3, 4, 5, None}
    assert (got[1]["record_type"], got[1]["refers_to"]) == ("revisit", 2)
    assert (got[3]["record_type"], got[3]["refers_to"], got[4]["record_type"]) == ("revisit", 4, "response")
    body = ("é" * 200_000).encode()
    assert got[5]["payload_bytes"] == len(body)
    assert got[5]["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert warc.record_summary(warc.archive_pages(pages.limit(0))).count() == 0


def test_bpe_round_trip(spark, docs, no_docs):
    tokenizer = bpe.load_tokenizer(TOKENIZER)
    got = rows(bpe.token_digests(spark, docs, TOKENIZER, block_bytes=600))
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert Counter(tuple(r.values()) for r in got) == Counter(want)
    assert bpe.token_digests(spark, no_docs, TOKENIZER).count() == 0


def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 16))
    base[100:140] = base[0] + 0.1 * rng.standard_normal((40, 16))
    base[200] = base[201]
    data = [(i, [float(x) for x in v], i % 3 if i < 100 else 0, "x") for i, v in enumerate(base)]
    data += [(900, None, 0, "x"), (901, [0.0] * 16, 0, "x"), (902, [float("nan")] * 16, 0, "x"), (903, [1.0] * 16, None, "x")]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, rep string")


def test_vector_near_duplicates(spark):
    df = vectors(spark)
    got = {r["vec_id"]: r for r in rows(neardup_vectors.near_duplicates(df))}
    data = [r for r in df.collect() if r["vec_id"] < 900]
    links = Counter()
    for a, b in itertools.combinations(data, 2):
        x, y = np.array(a["embedding"]), np.array(b["embedding"])
        if a["label"] == b["label"] and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
            links.update([a["vec_id"], b["vec_id"]])
    assert len(got) == len(data) + 4
    assert sum(got[i]["n_links"] != links[i] for i in got) <= 2
    assert not any(got[i]["n_links"] for i in (900, 901, 902, 903)) and got[900]["kept"]
    assert got[201]["component_id"] == 200 and not got[201]["kept"]
    assert neardup_vectors.near_duplicates(df.limit(0)).count() == 0


def test_posting_lists_recall(spark):
    df = vectors(spark)
    got = {}
    for r in rows(ann.search(df, every=20, k=20)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    data = {r["vec_id"]: np.array(r["embedding"]) for r in df.collect() if r["vec_id"] < 900 or r["vec_id"] == 903}
    found = 0
    for q in got:
        want = sorted((i for i in data if i != q), key=lambda i: (-float(data[q] @ data[i]), i))[:20]
        found += len(set(want) & {v for _, v in got[q]})
        assert [r for r, _ in sorted(got[q])] == list(range(1, 21))
    assert found >= 0.9 * 20 * len(got) and len(got) == 15
    assert ann.search(df.limit(0)).count() == 0


def shingled(text, n):
    words = bytes(text or "", "utf-8").lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def plain_components(sets, percent):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}


def test_jaccard_against_all_pairs(spark, docs, no_docs):
    rng = random.Random(1)
    base = [str(rng.randrange(50)) for _ in range(120)]
    data = []
    for i in range(120):
        words = list(base) if i % 2 else [str(rng.randrange(9)) for _ in range(rng.randrange(1, 40))]
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = "new%d" % rng.randrange(1000)
        data.append((i, " ".join(words)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for words, percent in ((3, 90), (5, 80), (1, 60)):
        want = plain_components({i: shingled(t, words) for i, t in data}, percent)
        got = {r["doc_id"]: r for r in rows(jaccard.near_duplicates(df, words, percent))}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(got[i]["n_shingles"] == len(shingled(t, words)) for i, t in data)
    odd = {r["doc_id"]: r for r in rows(jaccard.near_duplicates(docs, 3, 90))}
    assert odd[1]["component_id"] == 0 and odd[3]["n_shingles"] == 0 and odd[5]["component_id"] == 5 and odd[None]["component_id"] is None
    assert jaccard.near_duplicates(no_docs).count() == 0
    kept = jaccard.kept_documents(docs, 3, 90)
    assert kept.columns == docs.columns and 1 not in {r["doc_id"] for r in kept.collect()}


def test_quality_rules(spark, docs, no_docs):
    rng = random.Random(2)
    texts = [(i, " ".join("word%s" % ("$$$" if i % 2 else "") for _ in range(rng.randrange(5, 60)))) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i, _ in texts], "doc_id long, quality int, toxic int")
    got = rows(quality.quality_scores(df, labels))
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert held and sum(r["predicted"] == 1 - r["doc_id"] % 2 for r in held) / len(held) > 0.95
    odd = quality.classify(docs, labels)
    assert odd.count() == 13 and odd.where("score is null").count() == 0
    assert quality.quality_scores(no_docs, labels).count() == 0
    assert quality.quality_scores(df, labels.limit(0)).count() == 400


def test_surrogates(docs, no_docs):
    got = pii.replace_mentions(docs)
    assert got.count() == 13 and got.columns[:-1] == docs.columns
    text = [r["text"] for r in got.collect() if r["doc_id"] == 7][0]
    first, second = text.split()[1], text.split()[3].rstrip(",")
    assert first.lower() == second and "anna" not in text.lower() and first[0].isupper() and first.endswith(".com")
    assert "10.1.2.3" not in text and "4111 1111 1111 1111" not in text
    digits = [int(d) for d in text.split("card ")[1] if d.isdigit()]
    assert sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    same = {r["doc_id"]: r["text"] for r in got.collect()}
    assert same[3] is None and same[4] == "" and same[0] == same[1]
    assert pii.replace_mentions(no_docs).count() == 0


def test_surrogates_are_distinct(spark):
    data = [(i, f"mail a{i}@b{i}.org or 10.0.{i // 250}.{i % 250}") for i in range(500)]
    got = rows(pii.surrogate_documents(spark.createDataFrame(data, "doc_id long, text string")))
    mails = {r["text"].split()[1] for r in got}
    assert len(mails) == 500 and not mails & {t.split()[1] for _, t in data}


def plain_removed(data, least):
    first = {}
    for i, t in data:
        b = (t or "").encode()
        for k in range(len(b) - least + 1):
            first[b[k : k + least]] = min(first.get(b[k : k + least], i), i)
    out = {}
    for i, t in data:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, dtype=int)
        for k in range(len(b) - least + 1):
            if first[b[k : k + least]] < i:
                gone[k + 1 : k + least + 1] = 1
        kept = bytes(c for c, g in zip(b, gone[1:-1]) if not g)
        out[i] = (len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_removal(spark, docs, no_docs):
    data = [(r["doc_id"], r["text"]) for r in docs.where("doc_id < 10").collect()] + [(50, "x" * 120), (51, "x" * 80), (52, "y" * 20 + "x" * 60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = plain_removed(data, 50)
    for hot in (1, 1000):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffixes.without_repeats(df, hot=hot))}
        assert got == want
    assert suffixes.without_repeats(docs).count() == 13
    assert suffixes.without_repeats(no_docs).count() == 0


def test_shards_are_near_equal(spark, docs, no_docs):
    rng = random.Random(3)
    data = [(i, "a" * rng.randrange(100), "en" if i % 3 else "fr", "hot" if i % 3 else "s%d" % (i % 5)) for i in range(1500)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = rows(sharding.shard_by_bytes(df, 16))
    sizes = Counter()
    slots = {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len(data[r["doc_id"]][1]) + 1 and r["text_crc32"] == zlib.crc32(data[r["doc_id"]][1].encode())
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 4 * 100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(docs, 3).count() == 13
    assert sharding.shard_by_bytes(no_docs, 16).count() == 0


def test_mix_deviates_less_than_a_block(spark, docs, no_docs):
    df = spark.range(4000).selectExpr("id doc_id", "case when id % 3 = 0 then 'a' when id % 7 = 0 then null else concat('s', id % 5) end source")
    weights = {"a": 0.5, None: 0.1, "s1": 0.25, "s2": 0.15}
    got = rows(mixing.mix(df, weights, [df.doc_id], block_docs=4, cycle=20))
    assert len(got) == 4000
    placed = sorted(
        ((r["position"], r["source"] or "") for r in got if r["position"] is not None)
    )
    assert [p for p, _ in placed] == list(range(len(placed))) and len(placed) > 500
    parts = mixing.whole_parts(weights, 20)
    for source, share in parts.items():
        seen = 0
        for n, (_, s) in enumerate(placed[::4], 1):
            seen += s == (source or "")
            assert abs(seen - n * share / 20) < 1
    assert mixing.mix_documents(docs).count() == 13
    assert mixing.mix_documents(no_docs).count() == 0


def test_mix_goes_on_when_a_source_runs_dry(spark):
    df = spark.range(1000).selectExpr("id doc_id", "case when id < 3 then 'rare' when id < 16 then null when id % 2 = 0 then 'hot' else concat('s', id % 5) end source")
    sources = Counter(r["source"] for r in df.collect())
    got = rows(mixing.mix(df, mixing.tempered_weights(df), [df.doc_id]))
    assert sorted(r["position"] for r in got) == list(range(1000))
    assert Counter(r["source"] for r in got) == sources
    by_slot = {}
    for r in got:
        by_slot.setdefault(r["slot"], set()).add((r["source"], r["block"]))
    assert all(len(b) == 1 for b in by_slot.values())
    assert len(by_slot) == sum(-(-n // 8) for n in sources.values()) == max(by_slot) + 1
    unweighted = rows(mixing.mix(df, {"hot": 1.0}, [df.doc_id]))
    assert sorted(r["position"] for r in unweighted if r["source"] == "hot") == list(range(sources["hot"]))
    assert all(r["position"] is None for r in unweighted if r["source"] != "hot") and len(unweighted) == 1000


def test_schedule_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_SLOTS", 7)
    want = list(mixing.pfair_schedule({"a": 1.0, None: 2.0}, {"a": 100, None: 300}))
    got = mixing.stored_schedule(spark, iter(want)).collect()
    assert sorted(tuple(r) for r in got if r[0]) == [w for w in want if w[0]] and len(got) == len(want) == 51


def test_pipeline_mix_keeps_every_document(spark, docs):
    import corpus_pipeline

    docs = docs.drop("block", "slot")
    kept = corpus_pipeline.mix_sources(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_schedule_follows_the_given_weights():
    weights = {"hot": 1 / 3, None: 1e-6} | {f"s{i}": 2 / 57 for i in range(19)}
    total = sum(weights.values())
    counts = {s: 8 * 40_000 if s == "hot" else 8 * 5000 for s in weights}
    seen = Counter()
    for source, block, slot, position in itertools.islice(mixing.pfair_schedule(weights, counts), 20_000):
        assert block == seen[source] and position == 8 * slot
        seen[source] += 1
        # The source that gains and, every 1,000 blocks, all of them.
        for s in weights if slot % 1000 == 999 else (source,):
            assert abs(seen[s] - (slot + 1) * weights[s] / total) < 1


def test_schedule_of_many_sources():
    weights = {f"s{i}": float(1 + i % 7) for i in range(12_000)}
    placed = list(mixing.pfair_schedule(weights, {s: 9 + i % 5 for i, s in enumerate(weights)}))
    assert len(placed) == 24_000 and len({(s, b) for s, b, _, _ in placed}) == 24_000


def test_mix_follows_the_weights_not_parts_of_a_cycle(spark):
    df = spark.range(30_000).selectExpr("id doc_id", "case when id % 3 = 0 then 'hot' else concat('s', id % 19) end source")
    weights = {"hot": 1 / 3} | {f"s{i}": 2 / 57 for i in range(19)}
    order = sorted({(r["slot"], r["source"]) for r in rows(mixing.mix(df, weights, [df.doc_id]))})
    hot = 0
    for n, (_, source) in enumerate(order[:3000], 1):
        hot += source == "hot"
        assert abs(hot - n / 3) < 1


def test_surrogates_of_other_scripts_and_signs(spark):
    texts = [
        "password: ********", "token = ------------", "token = ____________", "password: 密码安全保护", "pwd=كلمةالسر", "pwd=סיסמאות",
        "mail 李明@例子.公司 x", "password: !@#$%^&*", "password: 비밀번호암호", "pwd=ПАРОЛЬ", "pwd=𝒂𝒃𝒄𝒅𝒆𝒇",
    ]
    got = {r["doc_id"]: r for r in rows(pii.surrogate_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))}
    for i, t in enumerate(texts):
        assert (got[i]["text"], got[i]["n_replaced"]) == (t, 0) if i < 3 else got[i]["text"] != t and got[i]["n_replaced"] == 1
    scripts = {3: "CJK", 4: "ARABIC", 5: "HEBREW", 8: "HANGUL", 9: "CYRILLIC CAPITAL"}
    for i, script in scripts.items():
        secret = got[i]["text"][10:] if i in (3, 8) else got[i]["text"][4:]
        assert len(secret) == len(texts[i]) - (10 if i in (3, 8) else 4) and all(unicodedata.name(c).startswith(script) for c in secret)
    assert not any(c.isalnum() for c in got[7]["text"][10:])


def test_more_entities_than_draws(spark):
    texts = [f"password: -----{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"tel +1 2{i} 3{j}." for i in range(10) for j in range(10)]
    got = [r["text"] for r in rows(pii.surrogate_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))]
    assert len(set(got)) == len(texts) and not set(got) & set(texts)


def test_cards_beside_numbers(spark):
    cards = {
        "card 4412473014894482 25 euros": "4412473014894482", "4111 1111 1111 1111 123": "4111 1111 1111 1111", "4111 1111 1111 1111 12/27": "4111 1111 1111 1111",
        "4111 1111 1111 1111 2025": "4111 1111 1111 1111", "12 4111 1111 1111 1111 ok": "4111 1111 1111 1111", "2025 4111-1111-1111-1111.": "4111-1111-1111-1111",
        "3782 822463 10005 1234": "3782 822463 10005", "4111111111111111 10.1.2.3": "4111111111111111", "4111111111111111 123-45-6789": "4111111111111111",
        "4111111111111111 12ab@mail.org": "4111111111111111", "4111 1111 1111 1111 5500 0000 0000 0004": "4111 1111 1111 1111", "44 1247 3014 8944 82 25": "44 1247 3014 8944 82",
    }
    got = {r["doc_id"]: r for r in rows(pii.surrogate_documents(spark.createDataFrame(list(enumerate([*cards, "4111 1111 1111 1112 euros"])), "doc_id long, text string")))}
    for i, (text, card) in enumerate(cards.items()):
        new = got[i]["text"]
        assert card not in new and new[: text.index(card)] == text[: text.index(card)] and len(new) >= len(text) - 8
        assert not any(x in new for x in ("10.1.2.3", "123-45-6789", "12ab@mail.org", "5500 0000 0000 0004"))
        assert got[i]["n_replaced"] == (2 if i in (7, 8, 9, 10) else 1)
        if got[i]["n_replaced"] == 1:
            assert new[text.index(card) + len(card) :] == text[text.index(card) + len(card) :]
    assert got[len(cards)]["n_replaced"] == 0 and got[len(cards)]["text"] == "4111 1111 1111 1112 euros"


def test_lasso_sees_every_path(spark, monkeypatch):
    last = (("x", ">", 0.5),)
    monkeypatch.setattr(quality, "tree_rules", lambda *_: [(("x", "<=", -1.0 - i),) for i in range(111)] + [last])
    train = spark.createDataFrame([(float(i % 2), float(i % 2)) for i in range(100)], "x double, label double")
    assert [r for r, _ in quality.fit_rules(train)[1]] == [last]
