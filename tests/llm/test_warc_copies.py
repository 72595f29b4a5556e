"""Every row of pages is a record, however equal rows are dealt to partitions."""

import base64
import hashlib
from collections import Counter, defaultdict

import pytest

from creditloom.llm import warc

PAGES = (
    [(7, "u", "same text", 1)] * 5 + [(7, "v", "same text", 1)] * 2 + [(3, None, "same text", 1)] * 3
    + [(9, "w", "é" * 100_000, 1)] * 3 + [(None, "n", "", 1)] * 2 + [(2, "n", None, 1), (4, "x", "x", 1)]
)


def expected(pages, least):
    groups = defaultdict(list)
    for page, url, html, _ in pages:
        groups[(html or "").encode()].append(page)
    rows = []
    for body, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i))
        response = len(ids) - 1
        for n, page in enumerate(ids):
            alone = len(body) < least or n == response
            rows.append((page, len(body), digest, "response" if alone else "revisit", None if alone else ids[response]))
    return Counter(rows)


@pytest.mark.parametrize("slices", [1, 4])
@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_record_per_row(spark, slices, least, threshold, monkeypatch):
    monkeypatch.setattr(warc, "COPY_BLOCK", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, copies int").repartition(slices)
        if slices == 1:
            pages = pages.coalesce(1)
        found = warc.record_summary(warc.archive_pages(pages, min_bytes=least)).collect()
        assert Counter(map(tuple, found)) == expected(PAGES, least)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
