"""The corpus pipeline: documents through five stages of creditloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is stored and read again before
the next one.  Quality, near duplicates and the mix decide which documents go on, surrogates change
texts; the mix stores its rows in the order they are to be read, and the last stage returns token ids with
that position.  SQL cannot express the learned and hashed stages, so the
tests compare with brute force instead.

NULL and empty texts are documents like others; rows without an id, repeated rows and further columns go
through all stages up to the last.  An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import bpe, jaccard, mixing, pii, quality
from creditloom.llm.common import staged, stored_order, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """The documents with columns named like an operator's own set aside, and the columns that give them back."""
    aside = {c: f"__kept_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(aside), [F.col(aside.get(c, c)).alias(c) for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    own, back = apart(docs, "score", "predicted")
    judged = quality.classify(own, table(spark, sf_dir, "labels"))
    return judged.where("predicted = 1").select(*back)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the least id."""
    return jaccard.kept_documents(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars is counted again."""
    own, back = apart(docs, "n_replaced")
    counted = pii.replace_mentions(own)
    if "n_chars" in docs.columns:
        counted = counted.withColumn("n_chars", F.length("text").cast("long"))
    return counted.select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mix; every source has a weight.

    Columns of the documents keep their values, also where they are named like the mix's own.  The mix is made
    of narrow rows; a text moves once to meet its position and once into the order.
    """
    own, back = apart(docs, "position")
    placed = stored_order(own, "__place")
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("crc")
    narrow = staged(placed.select(F.col("__place").alias("place"), "doc_id", "source", crc), "mix")
    mixed = mixing.mix(narrow, mixing.tempered_weights(narrow), [F.col("doc_id"), F.col("crc")])
    positions = mixed.select(F.col("place").alias("__place"), "position")
    ordered = placed.join(positions, "__place").repartitionByRange("position").sortWithinPartitions("position")
    return ordered.select(*back)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(position, doc_id, n_tokens, ids, text): token ids, and the text they decode to.

    ``position`` is the place of the document in the stored order of ``docs``, which is that of the mix.
    """
    placed = stored_order(docs.select("doc_id", "text"), "position")
    tokens = bpe.token_table(spark, placed, TOKENIZER, place="position")
    return tokens.select(F.col("place").alias("position"), "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_each),
    ("pii surrogates", replace_personal_data),
    ("pfair mix", mix_sources),
    ("bpe", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{number}")
    return docs
