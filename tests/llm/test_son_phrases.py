"""Mined phrases against plain counting: awkward rows, low supports, few and many shards, filters that are nearly full."""

import re
from collections import Counter

import numpy as np
import pytest

from lakeward.llm import son_phrases
from lakeward.llm.son_phrases import collocations, frequent_phrases

DDL = "doc_id bigint, text string, lang string, source string, shard string, gram string, n string, k int"


def pieces(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", low)]


def counted(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return f, n


def mined(rows, support, contained, top):
    f, n = counted(rows)
    frequent = {x: a for x, a in f.items() if a >= support and len(x[1]) > 1}
    around = Counter()
    for (lang, w), a in frequent.items():
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                around[lang, w[s:s + m]] = max(around[lang, w[s:s + m]], a)
    out = []
    for lang in n:
        found = []
        for (own, w), a in frequent.items():
            if own == lang and not (around[own, w] and 100 * around[own, w] >= contained * a):
                score, cut = min((2000000 * a // (f[lang, w[:c]] + f[lang, w[c:]]), c) for c in range(1, len(w)))
                found.append((-score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]]))
        out += [(lang, r, p.decode(), -a, l, x, n[lang], -s) for r, (s, a, p, l, x) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(9)
    rows = []
    for i in range(120):
        size = 3000 if i == 5 else int(rng.integers(0, 40))
        marks = rng.choice([" ", "  ", "\t", " \t ", ", ", ".\n", "\r\n", " é "], size, p=[.6, .08, .08, .04, .08, .05, .04, .03])
        text = "".join(f"{w}{m}" for w, m in zip([f"w{int(x)}" for x in rng.random(size) ** 2 * 25], marks))
        rows.append((i, text, ["en", "de", None][i % 3] if i % 7 else "es"))
    copies = [(200 + i, "The quick brown Fox; jumps over\tthe  lazy dog", "en") for i in range(40)]
    return rows + copies + [(300, None, "en"), (301, "", "fr"), (302, " .,\t;", "fr"), (None, "w1 w2 w3", "en"), (5, "w1 w2 w3", "de"), (5, "w1 w2 w3", "de"),
                            (303, "es en es en es en", "en"), (304, "en es en es en es", "es"), (305, "日本 語 日本 語\x0b日本 語", None), (306, "a" * 30_000, "de")]


@pytest.mark.parametrize("support, shards, bits", [(6, 5, 1 << 27), (30, 5, 1 << 27), (3, 2, 1 << 27), (2, 7, 1 << 27), (4, 3, 1 << 10)])
def test_awkward_rows(spark, monkeypatch, support, shards, bits):
    """Nulls, empty and long texts, rows given twice, clashing column names; a filter of 1,024 bits holds almost everything and loses nothing."""
    monkeypatch.setattr(son_phrases, "SHARDS", shards)
    monkeypatch.setattr(son_phrases, "FILTER_BITS", bits)
    monkeypatch.setattr(son_phrases, "HELD", 500)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, g, "s", "x", "y", "z", 1) for i, t, g in rows], DDL).repartition(4, "doc_id")
    got = sorted(tuple(r) for r in collocations(docs, support=support, top=60).collect())
    assert got == mined(rows, support, 80, 60)


def test_frequent_phrases_are_counted_whole(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, g, "s", "x", "y", "z", 1) for i, t, g in rows], DDL).repartition(2)
    found, size = frequent_phrases(docs, support=5)
    f, n = counted(rows)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in found.collect()} == {x: a for x, a in f.items() if a >= 5}
    assert {r["lang"]: r["n"] for r in size.collect()} == {x: a for x, a in n.items() if a}


def test_empty_table(spark):
    df = collocations(spark.createDataFrame([], DDL))
    assert df.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    assert df.collect() == []


def test_products_beyond_64_bits(spark):
    """Scores of counts near 10^13 are exact."""
    from pyspark.sql import functions as F

    a, l, r = 9_999_999_999_991, 19_999_999_999_983, 10_000_000_000_003
    df = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint")
    got = df.select(F.expr(son_phrases.SCORE).alias("s")).first()["s"]
    assert got == 2000000 * a // (l + r)


def test_last_pass_sends_a_phrase_about_once(spark, monkeypatch, tmp_path):
    """Phrases that every task holds: their rows do not grow with the tasks, and all are counted whole."""
    counting = son_phrases._global

    def counted_rows(*args):
        inner, folder = counting(*args), str(tmp_path)

        def task(it):
            import uuid
            from pathlib import Path

            n = 0
            for batch in inner(it):
                n += batch.num_rows
                yield batch
            Path(folder, f"{uuid.uuid4()}.{n}").touch()

        return task

    monkeypatch.setattr(son_phrases, "_global", counted_rows)
    line = " ".join(f"w{i}" for i in range(300))
    rows = [(i, f"own{i}. {line}", "en") for i in range(96)]
    docs = spark.createDataFrame([(i, t, g, "s", "x", "y", "z", 1) for i, t, g in rows], DDL).repartition(12)
    found, _ = frequent_phrases(docs)
    f, _ = counted(rows)
    expected = {x: a for x, a in f.items() if a >= 30}
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in found.collect()} == expected
    made = [int(p.suffix[1:]) for p in tmp_path.iterdir()]
    assert len(made) == 12 and len(expected) <= sum(made) <= 2 * len(expected)


def test_shards_that_have_not_counted_a_phrase(spark, monkeypatch):
    """A pair frequent in one shard alone: its few occurrences in the others, where its words are rare, still count; one short of the support stays out."""
    from pyspark.sql import functions as F

    ids = spark.range(3000).select("id", F.expr("'alpha beta. ' || repeat('common words here. ', 3)").alias("text"))
    asked = []
    wanted = son_phrases._wanted
    monkeypatch.setattr(son_phrases, "_wanted", lambda union: asked.append(union.filter("n0 = 0 or n1 = 0 or n2 = 0").count()) or wanted(union))
    slot = {r["id"]: r["s"] for r in ids.select("id", F.expr("pmod(xxhash64(id, text), 3)").alias("s")).collect()}
    home = [i for i in slot if slot[i] == 0]
    away = [[i for i in slot if slot[i] == x] for x in (1, 2)]
    text = "alpha beta. " + "common words here. " * 3
    for n, there in ((28, True), (27, False)):
        rows = [(i, text, "en") for i in home[:n] + away[0][:1] + away[1][:1]]
        rows += [(i, "common words here. " * 4, "en") for i in range(5000, 5300)]
        docs = spark.createDataFrame([(i, t, g, "s", "x", "y", "z", 1) for i, t, g in rows], DDL).repartition(3)
        found, _ = frequent_phrases(docs)
        f, _ = counted(rows)
        got = {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in found.collect()}
        assert got == {x: a for x, a in f.items() if a >= 30}
        assert (("en", ("alpha", "beta")) in got) == there
    assert asked[0] > 0
