"""The driver holds each plan, and again after every stage: a query names what it reads twice once."""

import pytest
from pyspark.sql import functions as F

from creditloom.llm import components, jaccard, pii


@pytest.fixture
def leaves(monkeypatch):
    """Leaves of the plan of every query that components and jaccard store."""
    found = []
    for module in (components, jaccard):
        def counted(df, name, *more, stored=module.staged):
            found.append((name, df._jdf.queryExecution().optimizedPlan().collectLeaves().size()))
            return stored(df, name, *more)

        monkeypatch.setattr(module, "staged", counted)
    return found


def test_a_round_of_components_reads_its_pairs_four_times_at_most(spark, leaves):
    edges = [(i, i + 1) for i in range(20)] + [(30, 40), (50, 50), (41, 40)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(21)} | {30: 30, 40: 30, 41: 30}
    assert len(leaves) > 3 and max(n for _, n in leaves) <= 4


def test_late_pairs_are_stored_where_they_are_read_again(spark, leaves):
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(4)]
    rows = [(i, texts[i % 4] + " end" * (i // 4)) for i in range(12)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 4 for i in range(12)}
    assert max(n for _, n in leaves) <= 10, sorted(leaves, key=lambda x: -x[1])[:3]


def test_a_surrogate_is_drawn_by_few_expressions(spark):
    rows = [("name", "mrs berg"), ("name", "г-н борис петров"), ("name", "xx berg"), ("card", "4111111111111111"), ("phone", "+4912345678")]
    drawn = spark.createDataFrame(rows, "kind string, canonical string").select(
        "canonical", pii.surrogate_of(F.col("kind"), F.col("canonical"), F.md5("canonical")).alias("surrogate")
    )
    assert drawn._jdf.queryExecution().analyzed().toString().count("sha2(") <= 30
    got = {r.canonical: r.surrogate for r in drawn.collect()}
    assert got["mrs berg"].startswith("mrs ") and len(got["mrs berg"]) == 14 and got["xx berg"] is None
    title, given, surname = got["г-н борис петров"].split(" ")
    assert title == "г-н" and given in [x.lower() for x in pii.GIVEN["cyrillic_male"]] and len(surname) == 10
    card = got["4111111111111111"]
    digits = [int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(card)]
    assert card[0] == "4" and len(card) == 16 and sum(d - 9 if d > 9 else d for d in digits) % 10 == 0
    assert got["+4912345678"].startswith("+49")
