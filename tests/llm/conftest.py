import pytest
from pyspark.sql import SparkSession

TEXT = "The quick brown fox jumps over the lazy dog and then runs away from it all, again and again. "
DOCS = [
    (0, TEXT * 4),
    (1, TEXT * 4),
    (2, TEXT * 4 + "One more sentence."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "word"),
    (7, "Mail Anna.Berg@mail.example.com or anna.berg@mail.example.com, IP 10.1.2.3, card 4111 1111 1111 1111."),
    (8, "héé <|endoftext|> it's 12345   \n\n x"),
    (9, "z" * 5000),
    (None, "no id"),
    (10, "again and again it repeats"),
    (10, "again and again it repeats"),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, copies, repeated rows, and columns whose names clash with inner ones."""
    rows = [(i, t, "en", f"src{(i or 0) % 2}" if i != 6 else None, len(t or ""), "extra", 1, 2.0) for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, block string, slot int, score double").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
