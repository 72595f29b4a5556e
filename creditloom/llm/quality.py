"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are built-in column expressions over the whole text.  Small boosted trees are grown on
labelled rows; every path from a root to a node becomes a rule (a conjunction of comparisons), a
logistic model with a lasso penalty weighs the rules, and the rules that keep a weight are compiled
into one column expression.  Scoring is a narrow projection: no shuffle, no Python.

Labelled rows are read up to TRAIN_ROWS, in order of a hash of doc_id; that bounds training only.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

TRAIN_ROWS = 20_000
TRAIN_TASKS = 2
TREES, DEPTH = 8, 3
LASSO = 0.002
SEED = 5

Rule = tuple[tuple[str, str, float], ...]


def counts(text: Column) -> Column:
    """What the statistics are made of, each pattern run once over the text."""
    body = F.coalesce(text, F.lit(""))

    def found(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern))

    # One mark per word is cheaper than a list of the words.
    words = F.when(body.rlike(r"\S"), F.length(F.regexp_replace(body, r"\s*+\S++\s*+", "w"))).otherwise(0)
    return F.struct(
        F.length(body).alias("chars"),
        words.alias("words"),
        found(r"[^\n]+").alias("lines"),
        found(r"\p{Lu}").alias("upper"),
        found("[0-9]").alias("digit"),
        found(r"[^\p{L}\p{N}\s.,;:'\"()-]").alias("symbol"),
        found("[.?!](?=\\s|$)").alias("stop"),
        found("[,;]").alias("comma"),
        found(r"(?<=\s)[^\p{L}\p{N}\s]+(?=\s)").alias("bar"),
        found(r"\p{L}[^\p{L}\p{N}\s]{2,}").alias("tail"),
        found(r"(?<!\p{L})\p{L}{16,}").alias("long"),
        found(r"(?<!\S)(\S++)(?=\s\1(?!\S))").alias("again"),
    )


def statistics(text: Column) -> Column:
    """Text statistics as a one-element array of a struct; 0 for an empty or NULL text.

    Shares are per character or per word.  The array hands the counts to a function of them: rules
    read statistics many times, and a filter on the score must not run the patterns as often.
    """

    def of(c: Column) -> Column:
        chars, words = F.greatest(c["chars"], F.lit(1)), F.greatest(c["words"], F.lit(1))
        named = {
            "log_chars": F.log1p(c["chars"]),
            "word_chars": c["chars"] / words,
            "line_words": c["words"] / F.greatest(c["lines"], F.lit(1)),
        }
        named |= {f"{n}_share": c[n] / chars for n in ("upper", "digit", "symbol")}
        named |= {f"{n}_share": c[n] / words for n in ("stop", "comma", "bar", "tail", "long", "again")}
        return F.struct(*[x.cast("double").alias(n) for n, x in named.items()])

    return F.transform(F.array(counts(text)), of)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(statistics, label) of at most ``most`` labelled rows; an id labelled twice counts once."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
        .groupBy("doc_id").agg(F.max("quality").alias("__quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        .select(F.col("doc_id").alias("__id"), "__quality")
    )
    # At most ``most`` ids: small enough for every task, so texts are not shuffled.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    measured = joined.select(F.col("__quality").cast("double").alias("label"), F.inline(statistics(F.col("text"))))
    return staged(measured, "quality-train").coalesce(TRAIN_TASKS)


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """The conjunctions of all root-to-node paths in a printed tree ensemble."""
    rules: dict[Rule, None] = {}
    path: list[tuple[str, str, float]] = []
    base = 0
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        if re.match(r"\s*Tree \d+", line):
            path, base = [], depth + 2
            continue
        found = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            path = path[: max(0, depth - base)]
            path.append((names[int(found[1])], found[2], float(found[3])))
            rules[simplified(tuple(path))] = None
    return list(rules)


def simplified(rule: Rule) -> Rule:
    """Keep the tightest bound per statistic and direction, in a fixed order."""
    bounds: dict[tuple[str, str], float] = {}
    for name, sign, value in rule:
        old = bounds.get((name, sign), value)
        bounds[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return tuple((n, s, v) for (n, s), v in sorted(bounds.items()))


def holds(rule: Rule, statistic: Callable[[str], Column] = F.col) -> Column:
    out = F.lit(True)
    for name, sign, value in rule:
        out = out & (statistic(name) <= value if sign == "<=" else statistic(name) > value)
    return out


def fit_rules(train: DataFrame) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, weighted rules).  Without rows of both labels: no rules, the share of label 1."""
    names = [c for c in train.columns if c != "label"]
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if set(counts) != {0.0, 1.0}:
        return (0.0 if not counts else 20.0 if 1.0 in counts else -20.0), []
    weighted = train.withColumn("__w", F.when(F.col("label") == 0, sum(counts.values()) / (2 * counts[0.0])).otherwise(sum(counts.values()) / (2 * counts[1.0])))
    table = VectorAssembler(inputCols=names, outputCol="features").transform(weighted).select("features", "label", "__w")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="__w", stepSize=0.3).fit(table)
    rules = tree_rules(trees.toDebugString, names)
    columns = [f"r{i}" for i in range(len(rules))]
    marks = weighted.select("label", "__w", *[holds(r).cast("double").alias(c) for c, r in zip(columns, rules)])
    matrix = VectorAssembler(inputCols=columns, outputCol="features").transform(marks).select("features", "label", "__w")
    model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, weightCol="__w", maxIter=60, tol=1e-5).fit(matrix)
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients) if abs(w) > 1e-6]
    return float(model.intercept), kept


def score_column(text: Column, intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The rules as one expression over the text."""

    def score(s: Column) -> Column:
        margin = F.lit(intercept)
        for rule, weight in rules:
            margin = margin + F.when(holds(rule, lambda n: s[n]), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))

    return F.element_at(F.transform(statistics(text), score), 1)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with ``score`` and ``predicted``; rows and other columns as they were.

    A NULL text counts as empty and gets a score; input columns score and predicted are replaced.
    """
    intercept, rules = fit_rules(training_rows(docs, labels))
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*own, score_column(F.col("text"), intercept, rules).alias("score"))
    return scored.select(*own, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return classify(docs.select("doc_id", "text"), labels).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
