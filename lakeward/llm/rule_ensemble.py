"""Quality classifier: a sparse ensemble of conjunctive rules.

Statistics of the text are Spark columns.  Shallow trees are grown on a bounded sample of labelled rows, every path from
a root is a conjunction of threshold tests, lasso logistic regression weighs the rules and drops most, and the
rules that are left are compiled to one Spark column: scoring is a projection without Python.

The sample is the ``sample_rows`` labelled rows of smallest hash (a documented bound on the fit;
scoring covers every row).  Labels, lang, source and doc_id are no inputs of the score.

Defined cases: null or empty texts have all statistics 0 and get a score like any row; rows with a null or
repeated label count once, by the smallest label; without labels of both kinds the score is the share of label 1
(0.5 without labels); repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import stored

SAMPLE_ROWS = 20_000         # labelled rows the fit may use
TREES, DEPTH = 16, 3
LASSO = 0.002
PREDICT_AT = 0.7

_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_SYMBOLS, _MARKS, _STOPS = "#*$%&|<>", "!?", ".,;:"


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; ratios are 0 for empty texts."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)

    def without(chars: str) -> Column:
        return n - F.length(F.translate(t, chars, ""))

    def per(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.when(b > 0, b), F.lit(0.0))

    spaces, lines = without(" \t\r\n"), without("\n")
    tokens = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    count = F.size(tokens)
    return {"log_chars": F.log1p(n.cast("double")), "symbols": per(without(_SYMBOLS), n), "marks": per(without(_MARKS), n),
            "upper": per(without(_UPPER), n), "digits": per(without(_DIGITS), n), "stops": per(without(_STOPS), n),
            "pipes": per(without("|"), n), "lines": per(lines, n), "word_size": per(n - spaces, count),
            "distinct": per(F.size(F.array_distinct(tokens)), count), "log_words": F.log1p(count.cast("double"))}


@dataclass(frozen=True)
class Rule:
    """Tests (statistic, is at most, threshold) that all hold, and the weight."""

    tests: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, value in self.tests:
            out = out & (F.col(name) <= F.lit(value) if at_most else F.col(name) > F.lit(value))
        return out


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """Probability of label 1 over the statistics' columns."""
        z = F.lit(self.bias)
        for r in self.rules:
            z = z + F.when(r.column(), F.lit(r.weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _paths(node, names: list[str], tests: tuple) -> list[tuple]:
    """Conjunctions of all nodes below the root of a fitted tree."""
    if node.subtreeDepth() == 0:
        return []
    split = node.split()
    name, value = names[split.featureIndex()], float(split.threshold())
    out = []
    for at_most, child in ((True, node.leftChild()), (False, node.rightChild())):
        own = tests + ((name, at_most, value),)
        out.append(own)
        out += _paths(child, names, own)
    return out


def _simplified(tests: tuple) -> tuple:
    """The tightest threshold of each statistic and direction, in a fixed order."""
    tight: dict[tuple[str, bool], float] = {}
    for name, at_most, value in tests:
        old = tight.get((name, at_most))
        tight[name, at_most] = value if old is None else (min if at_most else max)(old, value)
    return tuple((n, d, v) for (n, d), v in sorted(tight.items()))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH,
        lasso: float = LASSO, seed: int = 7) -> Ensemble:
    """Ensemble from documents (doc_id, text) and labels (doc_id, label 0 or 1)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    one = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = stored(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "rule-ids")     # ids and labels only
    rows = stored(docs.select("doc_id", "text").join(chosen, "doc_id").select(F.col("label").cast("double").alias("label"), *[c.alias(k) for k, c in statistics(F.col("text")).items()]), "rule-sample")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, total = counts.get(1.0, 0), sum(counts.values())
    if not ones or ones == total:
        share = ones / total if total else 0.5
        return Ensemble(max(-12.0, min(12.0, math.log((share + 1e-6) / (1 - share + 1e-6)))), ())
    names = list(statistics(F.lit("")))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(vectors)
    conjunctions = sorted({_simplified(p) for tree in forest._java_obj.trees() for p in _paths(tree.rootNode(), names, ())})
    rules = [Rule(t) for t in conjunctions]
    if not rules:
        return Ensemble(math.log(ones / (total - ones)), ())
    held = stored(rows.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)]), "rule-table")
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=200, standardization=False).fit(table)
    weights = model.coefficients.toArray().tolist()
    return Ensemble(float(model.intercept), tuple(Rule(r.tests, w) for r, w in zip(rules, weights) if w))


def score(docs: DataFrame, ensemble: Ensemble, predict_at: float = PREDICT_AT, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted; the statistics are dropped again."""
    prefix = {k: f"_s_{k}" for k in statistics(F.lit(""))}
    out = docs.withColumns({prefix[k]: c for k, c in statistics(F.col(text)).items()})
    named = Ensemble(ensemble.bias, tuple(Rule(tuple((prefix[n], d, v) for n, d, v in r.tests), r.weight) for r in ensemble.rules))
    return (out.withColumn("score", named.score()).drop(*prefix.values())
            .withColumn("predicted", (F.col("score") >= predict_at).cast("int")))
