"""The mix's order reaches the end of the pipeline, and columns with clashing names keep their values."""

from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import bpe, mixing
from creditloom.llm.common import staged, stored_order


def test_stored_order_follows_files_and_rows(spark):
    df = spark.range(5000).withColumn("name", F.concat(F.lit("n"), "id")).withColumn("position", F.lit(-1))
    stored = staged(df.repartitionByRange(7, F.col("id").desc()).sortWithinPartitions(F.col("id").desc()), "order")
    got = {r["id"]: r["position"] for r in stored_order(stored, "position").collect()}
    assert got == {i: 4999 - i for i in range(5000)}
    loose = stored_order(df.groupBy("name").agg(F.max("id").alias("id")), "position").collect()
    assert sorted(r["position"] for r in loose) == list(range(5000))
    assert stored_order(stored.limit(0), "position").count() == 0


def test_tokens_carry_the_position_of_the_mix(spark, docs):
    mixed = staged(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")))]
    own = docs.drop("block", "slot")
    want = {r["position"]: (r["doc_id"], r["text"] or "") for r in mixing.mix(own, mixing.tempered_weights(own), order).collect()}
    tokens = corpus_pipeline.tokenize(spark, mixed, "")
    assert tokens.columns == ["position", "doc_id", "n_tokens", "ids", "text"]
    got = {r["position"]: r for r in tokens.collect()}
    assert {p: (r["doc_id"], r["text"]) for p, r in got.items()} == want and len(want) == docs.count()
    plain = bpe.load_tokenizer(corpus_pipeline.TOKENIZER)
    for r in got.values():
        ids = plain.encode(want[r["position"]][1], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)


def test_stages_keep_clashing_columns(spark, docs):
    clashing = docs.withColumns({c: F.lit(f"own {c}") for c in ("position", "n_replaced", "predicted")})
    for stage in (corpus_pipeline.mix_sources, corpus_pipeline.replace_personal_data):
        kept = stage(spark, clashing, "")
        assert kept.columns == clashing.columns
        fixed = ["doc_id", "block", "slot", "score", "position", "n_replaced", "predicted"]
        assert sorted(map(str, kept.select(*fixed).collect())) == sorted(map(str, clashing.select(*fixed).collect()))
