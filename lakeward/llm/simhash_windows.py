"""Benchmark decontamination by SimHash over item-sized windows.

For a benchmark item of n words every window of n words of a document that holds enough shingles of
items of that size to reach the similarity gets a 64-bit SimHash.  (A window with fewer shares fewer with each item, so
leaving it out loses nothing.)
Fingerprints are cut into radius+1 blocks: two that differ in at most ``radius`` bits agree in one
block, so an equi-join on (size, block, bits) finds all pairs within the radius.
Those pairs are verified by exact weighted similarity: shingles weighted by
their count in window and item, sum of minima over sum of maxima.

The benchmark goes to the tasks as a table of shingles; it is cut into parts of at most
``part_words`` words and the documents are read once a part, so its size is bounded whatever it holds.
At the verified similarity the expected distance is under 10 bits (standard deviation 3); the default radius is 23.

Words are compared in ASCII lower case, ASCII punctuation counts as white space.
Defined cases: null or empty texts and items match nothing; an item shorter than a shingle is one shingle as
long as itself; a document shorter than an item is one window; repeated rows give repeated hits; null doc_ids or
item_ids are carried along; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.textkit import _A, hash_words, mix, signed, slices, stored, window_hash, words

SHINGLE = 5
PERCENT = 80
RADIUS = 23
PART_WORDS = 2_000_000       # benchmark words in one task-side table, about 50 MB

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def _word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _FOLD[data]
    starts, ends, first = words(low, off)
    return hash_words(low, starts, ends), first


def weighted(shingles: np.ndarray) -> np.ndarray:
    """A multiset as a set: the i-th occurrence of a shingle gets a name of its own."""
    s = np.sort(shingles)
    head = np.ones(len(s), dtype=bool)
    head[1:] = s[1:] != s[:-1]
    nth = np.arange(len(s)) - np.flatnonzero(head)[np.cumsum(head) - 1] if len(s) else np.zeros(0, np.int64)
    return mix(s + nth.astype(np.uint64) * _A)


def simhash(shingles: np.ndarray) -> np.uint64:
    """64-bit SimHash; repeated shingles weigh by their count."""
    bits = np.unpackbits(mix(shingles ^ _A).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    return np.packbits((2 * bits.sum(axis=0) > len(shingles)).astype(np.uint8)).view("<u8")[0]


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    return window_hash(h, min(k, len(h)))


_ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("shingles", pa.list_(pa.int64()))])
_ROW_DDL = "doc_id bigint, start bigint, n bigint, fp bigint, shingles array<bigint>"


def _least(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that sets of a and b need at least to reach the similarity."""
    return np.maximum(-(-percent * (a + b) // (100 + percent)), 1)


def _starts(p: np.ndarray, n: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Entry and start of every window of n words with enough hits, for hits p in documents from begin to end, ordered by (n, p).

    Of the starts whose first hit is the j-th, those whose window reaches the hit that makes the count full."""
    places, at = n - width + 1, np.arange(len(p))
    head = np.ones(len(p), dtype=bool)
    head[1:] = (n[1:] != n[:-1]) | (begin[1:] != begin[:-1])
    group = np.cumsum(head) - 1
    size = np.bincount(group)[group]
    long = end - begin >= n
    last = at + _least(places, places, percent) - 1
    full = np.minimum(last, len(p) - 1)
    fits = long & (last < len(p)) & (group[full] == group) & (p[full] - p < places)
    low = np.maximum(np.where(head, begin, np.append(0, p[:-1]) + 1), np.maximum(p[full] - places + 1, begin))
    count = np.where(fits, np.maximum(np.minimum(p, end - n) - low + 1, 0), 0)
    short = head & ~long & (size >= _least(np.maximum(end - begin - width + 1, 0), places, percent))     # the whole document
    count, low = np.where(short, 1, count), np.where(short, begin, low)
    entry = np.repeat(at, count)
    return entry, low[entry] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _windows(table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, percent: int):
    """table: shingle length -> (sorted shingles, first entry of each, item sizes)."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for rows, data, off in slices(batch):
                h, first = _word_hashes(data, off)
                found = []
                for width, (known, at, sizes) in table.items():
                    if len(h) < width:
                        continue
                    g = window_hash(h, width)
                    doc = np.searchsorted(first, np.arange(len(g)), "right") - 1
                    slot = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    p = np.flatnonzero((known[slot] == g) & (np.arange(len(g)) + width <= first[doc + 1]))
                    if not len(p):
                        continue
                    count = at[slot[p] + 1] - at[slot[p]]
                    entry = np.repeat(at[slot[p]], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    n, p = sizes[entry], np.repeat(p, count)
                    order = np.lexsort((p, n))
                    n, p = n[order], p[order]
                    d = doc[p]
                    entry, start = _starts(p, n, first[d], first[d + 1], width, percent)
                    found.append(np.stack([d[entry], n[entry], start - first[d[entry]]], axis=1))
                if not found:
                    continue
                out = []
                ids = rows.column(0).to_pylist()
                for d, n, start in np.unique(np.concatenate(found), axis=0).tolist():
                    a = first[d] + start
                    s = _shingles(h[a:min(a + n, first[d + 1])], min(k, n)) if first[d + 1] - a >= min(k, n) else None
                    if s is not None and len(s):
                        out.append((ids[d], start, n, signed(simhash(s).reshape(1))[0], signed(weighted(s))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)

    return task


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """item_id, n words, fingerprint, weighted shingles and the shingles in item order."""
    schema = pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("shingles", pa.list_(pa.int64())), ("ordered", pa.list_(pa.int64()))])

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for rows, data, off in slices(batch):
                h, first = _word_hashes(data, off)
                out = []
                for i, item in enumerate(rows.column(0).to_pylist()):
                    own = h[first[i]:first[i + 1]]
                    if len(own):
                        s = _shingles(own, k)
                        out.append((item, len(own), signed(simhash(s).reshape(1))[0], signed(weighted(s)), signed(s)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        task, "item_id bigint, n bigint, fp bigint, shingles array<bigint>, ordered array<bigint>")


def _table(rows: list, k: int) -> dict:
    """The task-side table of one part of the benchmark."""
    out = {}
    for width in sorted({min(k, r["n"]) for r in rows}):
        own = [r for r in rows if min(k, r["n"]) == width]
        s = np.concatenate([np.array(r["ordered"], dtype=np.int64) for r in own]).view(np.uint64)
        n = np.concatenate([np.full(len(r["ordered"]), r["n"]) for r in own])
        every = np.unique(np.stack([s, n.astype(np.uint64)], axis=1), axis=0)
        known, at = np.unique(every[:, 0], return_index=True)
        out[width] = (known, np.append(at, len(every)), every[:, 1].astype(np.int64))
    return out


def _parts(items: DataFrame, k: int, part_words: int) -> Iterator[dict]:
    """The tables of the benchmark's parts, each built when the one before has been used: the driver holds one part at a time."""
    held, size = [], 0
    for r in items.orderBy("n", "item_id").select("n", "ordered").toLocalIterator():
        held.append(r)
        size += r["n"]
        if size >= part_words:
            table = _table(held, k)
            held, size = [], 0
            yield table
    if held:
        yield _table(held, k)


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius+1 blocks that make up 64 bits."""
    count, out, at = radius + 1, [], 0
    for i in range(count):
        width = 64 * (i + 1) // count - 64 * i // count
        out.append((at, width))
        at += width
    return out


def _keyed(df: DataFrame, radius: int) -> DataFrame:
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)).alias("bits"))
                               for i, (a, w) in enumerate(_blocks(radius))]))
    return df.select("*", cells)


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                 radius: int = RADIUS, part_words: int = PART_WORDS) -> DataFrame:
    """A row per matching window: doc_id, item_id, start (word), n_words, hamming, similarity."""
    spark: SparkSession = docs.sparkSession
    items = stored(_items(benchmark, shingle), "benchmark-items")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    rows = None
    for part in _parts(items, shingle, part_words):
        got = stored(texts.mapInArrow(_windows(part, shingle, percent), _ROW_DDL), "item-windows")
        rows = got if rows is None else rows.unionByName(got)
    if rows is None:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, start bigint, n_words bigint, hamming int, similarity double")
    keyed = _keyed(rows.withColumn("window", F.struct("doc_id", "start", "n")), radius)
    own = _keyed(items.select("item_id", F.col("n").alias("i_n"), "fp", F.col("shingles").alias("i_shingles")), radius).withColumnsRenamed(
        {"fp": "i_fp", "block": "i_block", "bits": "i_bits"})
    near = keyed.join(own, (F.col("n") == F.col("i_n")) & (F.col("block") == F.col("i_block")) & (F.col("bits") == F.col("i_bits")))
    near = near.withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp")))).filter(F.col("hamming") <= radius)
    # of the blocks in which a pair agrees only the first yields it
    agree = F.lit(True)
    for i, (a, w) in enumerate(_blocks(radius)):
        mask = F.lit((1 << w) - 1)
        differs = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("i_fp")), a).bitwiseAND(mask) != 0
        agree = agree & ((F.col("block") <= i) | differs)
    near = near.filter(agree)
    both = F.size(F.array_intersect("shingles", "i_shingles"))
    union = F.size("shingles") + F.size("i_shingles") - F.col("both")
    return (near.withColumn("both", both).withColumn("union_size", union).filter(100 * F.col("both") >= percent * F.col("union_size"))
            .select("doc_id", "item_id", "start", F.col("n").alias("n_words"), "hamming", (F.col("both") / F.col("union_size")).alias("similarity")))
