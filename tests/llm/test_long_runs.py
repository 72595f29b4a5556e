"""Cards behind runs of numbers of any length."""

from creditloom.llm import pii

CARD = "4111 1111 1111 1111"


def test_cards_behind_long_runs(spark):
    texts = [
        "9" * 392 + " " + CARD,
        " ".join(["1234"] * 98) + " " + CARD + " end",
        " ".join(["7"] * 1_500) + " " + CARD,
        "run " + " ".join(["20 30 405"] * 500) + " " + CARD + " 10.0.0.1",
        CARD + "-" + "x",
        CARD + " 5500 0000 0000 0004-",
        "1" * 20_000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.surrogate_documents(docs).collect()}
    for n in range(6):
        assert CARD not in found[n].text and found[n].n_replaced >= 1, n
    assert "10.0.0.1" not in found[3].text and "5500 0000 0000 0004" not in found[5].text
    assert found[6].text == texts[6]
