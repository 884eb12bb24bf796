"""Ranked search against brute force: whole runs on awkward rows, and the bucket search alone on random vectors."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeward.llm import norm_buckets
from lakeward.llm.norm_buckets import _search, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DDL = "doc_id bigint, text string, terms string, n int, key string, class string, norm string, item string"


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, top):
    """(item_id, rank, doc_id, score) of every item, computed pair by pair."""
    own = [(i, terms(t)) for i, t in docs]
    total, length = sum(1 for _, w in own if w), sum(len(w) for _, w in own)
    df = Counter(t for _, w in own for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for doc, w in own:
            tf, score = Counter(w), 0
            for t in set(terms(text)) & set(w):
                m = 100 - 50 + ((50 * len(w) * total) // length)
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, -1 if doc is None else doc, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores, key=lambda x: x[:2])[:top], 1)]
    return sorted(out, key=str)


def corpus(rng, n, vocabulary=60):
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 12)) * (15 if i % 37 == 0 else 1)
        rows.append((i + 1, " ".join(f"t{int(x)}" for x in (rng.random(size) ** 3 * vocabulary))))
    return rows


@pytest.mark.parametrize("impacts", [norm_buckets.BUCKET_IMPACTS, 40])
def test_awkward_rows(spark, monkeypatch, impacts):
    """Nulls, empty and long texts, ties, rows given twice, other scripts, clashing column names; few and many buckets."""
    monkeypatch.setattr(norm_buckets, "BUCKET_IMPACTS", impacts)
    rng = np.random.default_rng(3)
    docs = corpus(rng, 150) + [(500, None), (501, ""), (502, " .,;- \n"), (None, "t1 T2 t3"), (7, "t1 t1 t1"), (7, "t1 t1 t1"), (503, "É日本-t4_t5\x00t6"),
                               (504, " ".join(f"t{i % 50}" for i in range(20_000))), (505, "t1 " * 3000), (506, "only here"), (507, "T1"), (508, "t1")]
    items = [(1, "t1 t2 t3 t2"), (2, "É日本 t4 nowhere"), (3, None), (4, ""), (5, "..."), (6, "only HERE é"), (6, "t40 t41 t55"), (None, "t9"),
             (8, " ".join(f"t{i}" for i in range(60))), (9, "absent")]
    frame = spark.createDataFrame([(i, t, "x", 1, "k", "c", "m", "i") for i, t in docs], DDL).repartition(3, "doc_id")
    asked = spark.createDataFrame([(i, t, "x", 2) for i, t in items], "item_id bigint, text string, weights string, least int")
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search(frame, asked, top=4).collect()), key=str)
    assert got == ranked(docs, items, 4)


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    no_items, item = (x.withColumnRenamed("doc_id", "item_id") for x in (none, one))
    for docs, items in ((none, item), (one, no_items), (none, no_items)):
        df = search(docs, items)
        assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")] and df.collect() == []


def test_bucket_search_loses_nothing_at_any_least_score():
    rng = np.random.default_rng(11)
    for round_ in range(60):
        vocabulary = [f"t{i}" for i in range(int(rng.integers(2, 30)))]
        docs = []
        for _ in range(int(rng.integers(1, 60))):
            own = rng.permutation(len(vocabulary))[:int(rng.integers(0, len(vocabulary)))]
            docs.append(([vocabulary[i] for i in own], [int(x) for x in rng.integers(0, 1_000_000, len(own))]))
        items = []
        for _ in range(5):
            own = rng.permutation(len(vocabulary))[:int(rng.integers(1, len(vocabulary)))]
            items.append(([vocabulary[i] for i in own], [int(x) for x in rng.integers(1, 9000, len(own))]))
        scores = [[sum(w * dict(zip(*d)).get(t, 0) for t, w in zip(*q)) for d in docs] for q in items]
        least = [sorted(s)[-min(len(s), 3)] if round_ % 2 else 1 for s in scores]
        table = pa.table({"key": list(range(len(docs))), "doc_id": [i // 2 for i in range(len(docs))], "terms": pa.array([d[0] for d in docs], pa.list_(pa.string())),
                          "impacts": pa.array([d[1] for d in docs], pa.list_(pa.int64())), "norm": [math.sqrt(sum(x * x for x in d[1])) for d in docs]})
        asked = pa.table({"item": list(range(5)), "terms": pa.array([q[0] for q in items], pa.list_(pa.string())),
                          "weights": pa.array([q[1] for q in items], pa.list_(pa.int64())), "least": pa.array(least, pa.int64())})
        got = {(r["item"], r["key"], r["score"]) for r in _search(10)(table, asked).to_pylist()}
        for i, s in enumerate(scores):
            reach = sorted((-x, k // 2, k) for k, x in enumerate(s) if x >= max(least[i], 1))[:10]
            assert {(k, x) for j, k, x in got if j == i} == {(k, -x) for x, _, k in reach}
