"""A block's documents are put together some at a time, whatever their number."""

import os

import pyarrow as pa

from creditloom.llm import bpe
from creditloom.llm.queries import TOKENIZER


def test_assembled_holds_some_documents_only(spark):
    n = 2 * bpe.ASSEMBLED_DOCS + 7
    docs = spark.createDataFrame([(i, f"word{i % 5} and word" if i % 9 else None) for i in range(n)], "doc_id long, text string").coalesce(1)
    rows = bpe.encode_documents(spark, docs, TOKENIZER)
    kinds = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())), ("body", pa.binary())])
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()], kinds)
    parts = list(bpe.assembled([batch]))
    assert max(len(p[0]) for p in parts) <= bpe.ASSEMBLED_DOCS
    assert all(len(p[0]) == len(p[1]) == len(p[2]) == len(p[3]) for p in parts)
    got = {i: t.decode() for p in parts for i, t in zip(p[0], p[3])}
    assert got == {i: f"word{i % 5} and word" if i % 9 else "" for i in range(n)}


def test_a_task_encodes_on_one_thread_and_gives_memory_back(spark):
    def grown(batches):
        import numpy as np

        from creditloom.llm.common import freed

        def held():
            with open("/proc/self/statm") as file:
                return int(file.read().split()[1]) * 4096

        for _ in batches:
            tokenizer, before = bpe.load_tokenizer(TOKENIZER), held()
            threads = len(os.listdir("/proc/self/task"))
            tokenizer.encode_batch([f"word {i}" for i in range(2000)], add_special_tokens=False)
            threads = len(os.listdir("/proc/self/task")) - threads
            kept = [np.ones(8000) for _ in range(3000)]  # 192 MB in pieces that malloc keeps
            last = kept[-1]
            del kept
            freed()
            yield pa.RecordBatch.from_pydict({"threads": pa.array([threads], pa.int64()), "kept": pa.array([held() - before - last.nbytes], pa.int64())})

    row = spark.range(0, 1, 1, 1).mapInArrow(grown, "threads long, kept long").first()
    assert row["threads"] == 0 and row["kept"] < 60e6
