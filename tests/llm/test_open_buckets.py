"""Documents that share boilerplate: buckets stay in many components, so their members are compared in full."""

import numpy as np
import pytest

from lakeward.llm import odd_sketch


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def groups(rows):
    sets, low = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in sets:
        for j in sets:
            if i < j:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    low[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("block, size", [(odd_sketch.BLOCK, odd_sketch.BLOCK_BYTES), (16, 4000)])
def test_boilerplate_around_short_texts(spark, monkeypatch, block, size):
    """Similarity near 0.6 throughout, some pairs and chains above 0.8, some long texts; blocks of a few members too."""
    monkeypatch.setattr(odd_sketch, "BLOCK", block)
    monkeypatch.setattr(odd_sketch, "BLOCK_BYTES", size)
    rng = np.random.default_rng(2)
    boiler = [f"license{i}" for i in range(100)]
    own = {i: [f"w{int(x)}" for x in rng.integers(0, 10**9, 30)] for i in range(150)}
    for i in range(0, 60, 3):                                     # a chain: each a few words from the one before
        own[i + 1] = own[i][:26] + own[i + 1][26:]
        own[i + 2] = own[i + 1][:2] + own[i + 2][2:6] + own[i + 1][6:]
    rows = [(i, " ".join(boiler + w + (["tail"] * i if i > 140 else []))) for i, w in own.items()]
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == groups(rows)
    assert any(r["component_id"] != r["doc_id"] for r in got)


def test_a_pair_is_compared_in_its_first_shared_band_alone(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 50, 60)) for _ in range(30)]
    bands = rng.integers(0, 3, (30, odd_sketch.BANDS))
    seen = []
    monkeypatch.setattr(odd_sketch, "_linked_all", lambda x, others, percent: seen.append(len(others)) or np.zeros(len(others), dtype=bool))
    for band in range(odd_sketch.BANDS):
        table = pa.table({"bucket": [band] * 30, "doc_id": list(range(30)), "component": list(range(30)), "side": [2] * 30, "band": [band] * 30,
                          "n_shingles": [56] * 30, "sketch": pa.array([[0] * 8] * 30, pa.list_(pa.int64())), "bands": pa.array(bands.tolist(), pa.list_(pa.int64())), "text": texts})
        odd_sketch._blocks(5, 80, odd_sketch.SIFT)(table)
    shared = sum(bool((bands[i] == bands[j]).any()) for i in range(30) for j in range(i))
    assert sum(seen) <= 30 * 29 / 2 and sum(seen) >= shared
