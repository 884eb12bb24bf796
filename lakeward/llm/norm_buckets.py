"""Ranked lexical search by inner products: documents in buckets of like norm.

A document is a vector of impacts (one per term, from the term's count and the text's
length), an item a vector of term weights; the score is their inner product.

1. One pass over the texts keeps, per document, its length and the counts of the terms that the items may hold
   (a bloom filter of fixed size, built from the items, decides; what it lets through besides only loosens a norm).
2. Documents fall into classes by the length of their impact vector (eight classes to a doubling); a class is cut
   into buckets of a bounded number of impacts, so a class that holds most documents is many buckets.
3. A first search, among the documents of highest impact in each item's rarest terms, gives every item a score that its
   k-th best document reaches at least.
4. Cauchy-Schwarz: an item is sent to the classes only whose norm times its own reaches that score.
5. Within a bucket the item's heaviest coordinates are looked at first, as many as it takes until the others alone cannot reach the
   score; documents holding none of them are out. The others are bounded by what those coordinates give plus
   Cauchy-Schwarz on the rest, and survivors are scored exactly, in 64-bit integers.
6. The best k of each bucket, then of all.

Nothing is sampled: every document lies in a bucket, and a bound only rules out what is below an item's k-th best.
All steps are joins and grouped tasks of bounded size over stored tables; a lost task is run again on the same rows.

Defined cases: a null or empty text has no terms and is never ranked, nor counted in the number of documents; an item without terms has no
rows; rows given twice are documents (or items) of their own; a null doc_id ranks before others of equal score; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.textkit import as_batches, hash_words, lower_ascii, slices, stored, words

TOP = 50
FILTER_BITS = 1 << 23        # of the items' terms: one megabyte, whatever their number
BUCKET_IMPACTS = 1 << 18     # impacts of a bucket, about
SEED_TERMS = 5               # rarest terms of an item whose best documents it meets first
_SLACK = 1 + 1e-9            # of bounds computed in doubles

_BETWEEN = np.ones(256, dtype=bool)          # bytes that are in no term: all ASCII but letters and digits
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _spots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _counted(bits: np.ndarray | None):
    """Rows (doc_id, n, terms, counts): the terms the filter lets through, each once."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def rows(r: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> list:
        data = lower_ascii(data)
        starts, ends, first = words(data, off, _BETWEEN)
        h = hash_words(data, starts, ends)
        doc = np.repeat(np.arange(r.num_rows), np.diff(first))
        if bits is not None:
            x, y = _spots(h)
            at = np.flatnonzero((bits[x >> np.uint64(6)] >> (x & np.uint64(63)) & bits[y >> np.uint64(6)] >> (y & np.uint64(63))) & np.uint64(1))
            h, doc, starts, ends = h[at], doc[at], starts[at], ends[at]
        order = np.lexsort((h, doc))
        h, doc, starts, ends = h[order], doc[order], starts[order], ends[order]
        new = np.ones(len(h) + 1, dtype=bool)
        new[1:-1] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        count, heads = np.diff(heads), heads[:-1]
        size = (ends - starts)[heads]
        at = np.zeros(len(heads) + 1, dtype=np.int64)
        np.cumsum(size, out=at[1:])
        flat = data[np.arange(at[-1]) + np.repeat(starts[heads] - at[:-1], size)]
        names = pa.Array.from_buffers(pa.string(), len(heads), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(flat)])
        bound = pa.array(np.searchsorted(doc[heads], np.arange(r.num_rows + 1)).astype(np.int32))
        return [r.column(0), np.diff(first), pa.ListArray.from_arrays(bound, names), pa.ListArray.from_arrays(bound, pa.array(count))]

    return lambda it: as_batches(it, rows, out)


_COUNTED = "doc_id bigint, n bigint, terms array<string>, counts array<bigint>"


def _filter_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for _, data, off in slices(batch, "term"):
            x = np.concatenate(_spots(hash_words(data, off[:-1], off[1:])))
            yield pa.RecordBatch.from_arrays([pa.array((x >> np.uint64(6)).astype(np.int64)),
                                              pa.array((np.uint64(1) << (x & np.uint64(63))).view(np.int64))], ["place", "bits"])


def _filter(terms: DataFrame) -> np.ndarray:
    """Bloom filter of a column of terms; at most FILTER_BITS reach the driver."""
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    got = terms.select("term").mapInArrow(_filter_words, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits[got["place"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return bits


def _search(k: int):
    """Item and document rows of one bucket -> the item's best documents in it, as far as they reach the item's least score."""
    out = pa.schema([("item", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def task(docs: pa.Table, items: pa.Table) -> pa.Table:
        if not docs.num_rows or not items.num_rows:
            return out.empty_table()
        names = pc.unique(items["terms"].combine_chunks().flatten())
        lists = docs["terms"].combine_chunks()
        size = pc.list_value_length(lists).to_numpy()
        code = pc.fill_null(pc.index_in(lists.flatten(), value_set=names), len(names)).to_numpy()
        value = docs["impacts"].combine_chunks().flatten().to_numpy()
        owner = np.repeat(np.arange(docs.num_rows), size)
        order = np.argsort(code, kind="stable")
        post = np.searchsorted(code[order], np.arange(len(names) + 1))
        owner, value = owner[order], value[order]
        norm = docs["norm"].to_numpy()
        most, square = norm.max(initial=0.0), norm * norm
        key, doc_id = docs["key"].to_numpy(), pc.fill_null(docs["doc_id"], np.iinfo(np.int64).min).to_numpy()
        found: list[list[np.ndarray]] = [[], [], []]
        ids = items["item"].to_pylist()
        least = items["least"].to_pylist()
        own = items["terms"].combine_chunks()
        for i, item in enumerate(ids):
            term = pc.index_in(own[i].values, value_set=names).to_numpy()
            weight = items["weights"].combine_chunks()[i].values.to_numpy()
            heavy = np.argsort(-weight, kind="stable")
            term, weight = term[heavy], weight[heavy]
            rest = np.sqrt(np.append(np.cumsum((weight.astype(float) ** 2)[::-1])[::-1], 0.0))   # norm of the coordinates from each on
            focus = int(np.argmax(rest * most * _SLACK < least[i])) if (rest * most * _SLACK < least[i]).any() else len(term)
            runs = [slice(post[t], post[t + 1]) for t in term]
            if not focus:
                continue
            at = np.concatenate([owner[r] for r in runs[:focus]])
            if not len(at):
                continue
            x = np.concatenate([value[r] for r in runs[:focus]])
            w = np.repeat(weight[:focus], [r.stop - r.start for r in runs[:focus]])
            part = np.bincount(at, w.astype(float) * x, minlength=docs.num_rows)
            used = np.bincount(at, x.astype(float) ** 2, minlength=docs.num_rows)
            bound = part + rest[focus] * np.sqrt(np.maximum(square - used, 0.0)) + 1e-6
            alive = (bound * _SLACK >= least[i]) & (used > 0)
            score = np.zeros(docs.num_rows, dtype=np.int64)
            for r, own_weight in zip(runs, weight):
                here = alive[owner[r]]
                score[owner[r][here]] += own_weight * value[r][here]
            best = np.flatnonzero(score >= max(least[i], 1))
            if len(best) > k:
                best = best[np.lexsort((key[best], doc_id[best], -score[best]))[:k]]
            found[0].append(np.full(len(best), item))
            found[1].append(best)
            found[2].append(score[best])
        if not found[0]:
            return out.empty_table()
        at = np.concatenate(found[1])
        return pa.table([pa.array(np.concatenate(found[0])), pa.array(key[at]), docs["doc_id"].combine_chunks().take(pa.array(at)), pa.array(np.concatenate(found[2]))], schema=out)

    return task


def _best(vectors: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, key, doc_id, score, rank): the ``k`` best documents of each item among ``vectors``, found bucket by bucket.
    ``items``: item, terms, weights, norm and least, a score that its k-th best document is known to reach."""
    classes = vectors.groupBy("class").agg(F.ceil(F.sum(F.size("terms")) / BUCKET_IMPACTS).cast("bigint").alias("parts"), F.max("norm").alias("most"))
    classes = stored(classes, "lemp-classes")            # eight rows a doubling of the norm
    dealt = vectors.join(F.broadcast(classes.select("class", "parts")), "class").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    wanted = (items.select("item", "terms", "weights", "least", F.col("norm").alias("own"), F.explode(F.sequence(F.col("lowest"), F.col("highest"))).alias("class"))
              .join(F.broadcast(classes), "class").filter(F.col("own") * F.col("most") * _SLACK >= F.col("least"))
              .select("item", "terms", "weights", "least", "class", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")))
    got = (dealt.select("key", "doc_id", "terms", "impacts", "norm", "class", "part").groupBy("class", "part")
           .cogroup(wanted.groupBy("class", "part")).applyInArrow(_search(k), "item bigint, key bigint, doc_id bigint, score bigint"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "key")
    return got.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _class(norm):
    return F.floor(F.log2(norm) * 8).cast("int")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` best documents (doc_id, text) of every item (item_id, text)."""
    parts = items.select(F.col("item_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_counted(None), _COUNTED)
    asked = stored(parts.filter("n > 0").select(F.monotonically_increasing_id().alias("item"), F.col("doc_id").alias("item_id"), "terms"), "lemp-items")
    bits = _filter(asked.select(F.explode("terms").alias("term")))
    read = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_counted(bits), _COUNTED)
    counted = stored(read.withColumn("key", F.monotonically_increasing_id()), "lemp-counts")

    total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    N, L = total["N"], total["L"]
    m = F.lit(50) + F.expr(f"(50 * n * {N}L) div {max(L, 1)}L")
    impact = F.transform("counts", lambda tf: F.call_function("div", F.lit(1_000_000_000).cast("bigint") * tf, 1000 * tf + 20 * F.col("m")))
    vectors = (counted.filter(F.size("terms") > 0).withColumn("m", m).withColumn("impacts", impact)
               .withColumn("norm", F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
               .filter("norm > 0").select("key", "doc_id", "terms", "impacts", "norm", _class(F.col("norm")).alias("class")))
    vectors = stored(vectors, "lemp-vectors")

    postings = vectors.select("key", F.explode(F.arrays_zip("terms", "impacts")).alias("p")).select("key", F.col("p.terms").alias("term"), F.col("p.impacts").alias("impact"))
    seen = postings.groupBy("term").agg(F.count("*").alias("df"))
    coordinates = stored(asked.select("item", "item_id", F.explode("terms").alias("term")).join(seen, "term")
                         .withColumn("weight", F.floor(1000 * F.log((2 * F.lit(N) + 2) / (2 * F.col("df") + 1))).cast("bigint")), "lemp-coordinates")
    span = vectors.agg(F.min("class").alias("lowest"), F.max("class").alias("highest")).first()
    if span["lowest"] is None:
        return coordinates.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("score")).filter("false")
    queries = (coordinates.filter("weight > 0").groupBy("item", "item_id")
               .agg(F.collect_list(F.struct("term", "weight")).alias("c"), F.sqrt(F.sum(F.col("weight").cast("double") * F.col("weight"))).alias("norm"))
               .select("item", "item_id", F.col("c.term").alias("terms"), F.col("c.weight").alias("weights"), "norm"))
    queries = stored(queries, "lemp-queries")

    rare = Window.partitionBy("item").orderBy(F.desc("weight"), "term")
    seeds = coordinates.withColumn("r", F.row_number().over(rare)).filter(F.col("r") <= SEED_TERMS).select("term").distinct()
    strong = Window.partitionBy("term").orderBy(F.desc("impact"), "key")
    first = postings.join(seeds, "term", "left_semi").withColumn("r", F.row_number().over(strong)).filter(F.col("r") <= top).select("key").distinct()
    met = stored(vectors.join(first, "key", "left_semi"), "lemp-first")
    all_classes = {"lowest": F.lit(span["lowest"]), "highest": F.lit(span["highest"])}
    least = _best(met, queries.withColumns({"least": F.lit(1).cast("bigint"), **all_classes}), top).filter(F.col("rank") == top).select("item", F.col("score").alias("least"))

    known = stored(queries.join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("bigint"))), "lemp-known")
    lowest = F.greatest(F.lit(span["lowest"]), _class(F.col("least") / F.col("norm")) - 1)
    known = known.withColumns({"lowest": lowest, "highest": F.lit(span["highest"])}).filter("lowest <= highest")
    reached = known.agg(F.min("lowest")).first()[0]           # no item is sent below this class
    if reached is None:
        return known.select("item_id", F.lit(1).alias("rank"), "item", "least").filter("false").toDF("item_id", "rank", "doc_id", "score")
    got = _best(vectors.filter(F.col("class") >= reached), known, top)
    return got.join(known.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
