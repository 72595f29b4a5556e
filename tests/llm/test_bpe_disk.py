"""Documents wait where they are stored; only words are shuffled."""

import re

from pyspark.sql import functions as F

from creditloom.llm import bpe
from creditloom.llm.common import staged_by
from creditloom.llm.queries import TOKENIZER


def test_documents_of_a_block_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"word{i % 5} and {i * 7919 % 1009} word" if i % 9 else None) for i in range(300)], "doc_id long, text string").repartition(4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables of some size
    try:
        rows = bpe.encode_documents(spark, docs, TOKENIZER, block_bytes=500)
        got = {r["doc_id"]: r["text"] for r in bpe.token_table(spark, docs, TOKENIZER).collect()}
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    # Of the exchanges none has the documents' columns.
    assert "Exchange" in plan and "doc_ids" in plan
    lines = plan.splitlines()
    above = next(i for i, x in enumerate(lines) if "FileScan" in x and "doc_ids" in x)
    join = max(i for i in range(above) if re.search("Join", lines[i]))
    assert not any("Exchange" in x for x in lines[join:above])


def test_stored_by_a_key_without_an_entry_left_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = spark.range(1000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    stored = staged_by(rows, "by-key", "k", 3)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    sums = stored.groupBy("k").agg(F.sum("v").alias("s"))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, rows.groupBy("k").agg(F.sum("v")).collect()))
