"""Near-duplicate groups: MinHash bands find candidates, odd sketches sift
them, full shingle sets confirm them.

A document's MinHash samples (index and value) are folded into a parity
bitmap: each sample flips one bit.  The XOR of two bitmaps has one bit per
sample that differs, up to collisions, so its population count estimates the
similarity; at high similarity few bits differ and the estimate is sharp.

1. Documents of one shingle set are one class (its smallest doc_id stands for it).
2. Classes that share a band of samples form a bucket; buckets of equal members are one bucket.
3. Every member is held against two of the bucket's (stars, linear in the bucket), its smallest and the
   one that shares most buckets with others, which in a group of edited copies is the copy next to all:
   sketch first, then the two whole texts' shingle sets.
4. In buckets that are still in several components all members of different components are held against each
   other: first sizes and sketches alone, in blocks of members, which leaves the members with a near one; then
   those members' whole texts, in blocks bounded by bytes, until they are linked.  A pair that shares several bands is
   compared in the first of them alone.  Nothing is capped, no link is left out.
5. Components of confirmed links.

At the linking similarity a pair misses all bands with probability 5e-8 and
the sift's margin is over six standard deviations.

Defined cases: null or empty texts, or texts without words, have no shingles and stand
alone; repeated rows of one doc_id count as one document, each row returned;
null doc_ids are returned unlinked and kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.components import components
from lakeward.llm.textkit import _A, _M2, as_batches, hash_words, lower_ascii, mix, signed, slices, stored, window_hash, words

SHINGLE, PERCENT = 5, 80     # defaults for near duplicates: five words, similarity of 0.8
ROWS = 4                     # samples a band
BANDS = 32
SKETCH_BITS = 512
SIFT = 0.54                  # least estimated similarity that goes to the exact comparison, for 0.8
BLOCK = 1024                 # members of a bucket whose sketches are compared with another such block in one task
TOGETHER = 64                # members whose shingle sets are held against one at once
BLOCK_BYTES = 2 << 20        # text, about, that is compared with as much in one task
CELLS = 1 << 24              # bits of the table that sifts texts before they are shuffled: 262,144 rows at most, whatever the input

_SEEDS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * _A) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, sorted within it, and where
    each document's begin; a text of fewer than ``k`` words is one shingle."""
    low = lower_ascii(data)
    starts, ends, first = words(low, off)
    h = hash_words(low, starts, ends)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    if len(h) >= k:
        at = np.flatnonzero(doc[k - 1:] == doc[:len(doc) - k + 1])
        sh, sd = window_hash(h, k)[at], doc[at]
    else:
        sh, sd = h[:0], doc[:0]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        own = np.array([_fold(h[first[i]:first[i + 1]]) for i in short], dtype=np.uint64)
        sh, sd = np.concatenate([sh, own]), np.concatenate([sd, short])
    order = np.lexsort((sh, sd))
    sh, sd = sh[order], sd[order]
    new = np.ones(len(sh), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])
    sh, sd = sh[new], sd[new]
    return sh, np.searchsorted(sd, np.arange(len(n) + 1))


def _fold(h: np.ndarray) -> np.uint64:
    out = mix(np.full(1, len(h), dtype=np.uint64))
    for x in h:
        out = mix(out * _A ^ x)
    return out[0]


_SIG = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                  ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])
_SIG_DDL = "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, sketch array<bigint>, bands array<bigint>"


def _signature(k: int):
    def rows(r: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> list:
        sh, first = shingle_sets(data, off, k)
        n = np.diff(first)
        some = np.flatnonzero(n > 0)
        s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
        sketch = np.zeros((len(n), SKETCH_BITS // 64), dtype=np.uint64)
        bands = np.zeros((len(n), BANDS), dtype=np.uint64)
        if len(some):
            at = first[:-1][some]
            s1[some] = np.add.reduceat(mix(sh), at)
            s2[some] = np.add.reduceat(mix(sh * _M2 + _A), at)
            low = np.empty((len(some), ROWS * BANDS), dtype=np.uint64)
            base = mix(sh ^ _A)
            for i, seed in enumerate(_SEEDS):
                x = base * seed
                low[:, i] = np.minimum.reduceat(x ^ (x >> np.uint64(29)), at)
            b = np.zeros((len(some), BANDS), dtype=np.uint64)
            for j in range(ROWS):
                b = mix(b * _A ^ low[:, j::ROWS])
            bands[some] = b
            bit = mix(low * _M2 + _SEEDS) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
            flat = sketch[some]
            line = np.repeat(np.arange(len(some)), ROWS * BANDS)
            np.bitwise_xor.at(flat, (line, (bit >> np.uint64(6)).astype(np.int64).ravel()),
                              (np.uint64(1) << (bit & np.uint64(63))).ravel())
            sketch[some] = flat
        lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(signed(m.ravel())))
        return [r.column(0), n.astype(np.int64), signed(s1), signed(s2), lists(sketch), lists(bands)]

    return lambda it: as_batches(it, rows, _SIG)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, set size, 128-bit set identity, odd sketch and band keys of every row."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_signature(shingle), _SIG_DDL)


def estimate(x: str, y: str):
    """Similarity estimated from two odd sketches (columns of bigint words)."""
    odd = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)
    differ = F.greatest(F.lit(1e-9), 1 - 2 * odd / F.lit(SKETCH_BITS))
    return 1 + F.log(differ) * SKETCH_BITS / 2 / (2 * ROWS * BANDS)


def _confirm(k: int, percent: int):
    """Pairs (a, b, a_text, b_text) whose whole shingle sets reach the similarity."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for rows, data, off in slices(batch, "a_text"):
                left, l0 = shingle_sets(data, off, k)
                right, r0 = [], [0]
                for _, d, o in slices(pa.RecordBatch.from_arrays([rows.column(3)], ["text"])):
                    s, p = shingle_sets(d, o, k)
                    right.append(s)
                    r0.extend((p[1:] + r0[-1]).tolist())
                right = np.concatenate(right)
                ok = []
                for i in range(rows.num_rows):
                    x, y = left[l0[i]:l0[i + 1]], right[r0[i]:r0[i + 1]]
                    ok.append(_linked(x, y, percent))
                got = np.flatnonzero(ok)
                if len(got):
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(got)), rows.column(1).take(pa.array(got))], schema=out)

    return task


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = int(np.isin(x, y, assume_unique=True).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _linked_all(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each of the sorted, non-empty sets is linked with ``x``."""
    if not others:
        return np.zeros(0, dtype=bool)
    size = np.array([len(y) for y in others])
    every = np.concatenate(others)
    same = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    both = np.add.reduceat(same.astype(np.int64), np.cumsum(size) - size)
    return 100 * both >= percent * (len(x) + size - both)


def _popcounts(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(others ^ x).sum(axis=1)


def _differing(sift: float) -> float:
    """Bits in which two sketches differ at the least estimated similarity."""
    return SKETCH_BITS / 2 * (1 - np.exp(-(1 - sift) * 2 * ROWS * BANDS * 2 / SKETCH_BITS))


def _partners(table: pa.Table, percent: int, sift: float):
    """For every member of a pair of blocks, those after it that it may be linked with: another component, like size, near sketch."""
    comp, side, size = (table[c].to_numpy() for c in ("component", "side", "n_shingles"))
    sketch = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(comp), -1)
    most, within = _differing(sift), bool((side == 2).any())
    other = np.flatnonzero(side == 1)
    for i in np.flatnonzero(side != 1):
        rest = np.arange(i + 1, len(comp)) if within else other
        rest = rest[(100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])) & (comp[rest] != comp[i])]
        odd = _popcounts(sketch[i], sketch[rest])
        near = odd <= most
        yield i, rest[near][np.argsort(odd[near], kind="stable")]


def _sifted(percent: int, sift: float):
    """The members of a pair of blocks with a possible partner."""

    def task(table: pa.Table) -> pa.Table:
        hit = np.zeros(table.num_rows, dtype=bool)
        for i, near in _partners(table, percent, sift):
            hit[near] = True
            hit[i] |= bool(len(near))
        return table.select(["bucket", "doc_id"]).filter(pa.array(hit))

    return task


def _blocks(k: int, percent: int, sift: float):
    """Links between members of different components of one pair of blocks."""

    def task(table: pa.Table) -> pa.Table:
        node, band = table["doc_id"].to_numpy(), table["band"].to_numpy()
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        comp = table["component"].to_numpy().copy()
        sets: list = []
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for _, d, o in slices(batch):
                s, p = shingle_sets(d, o, k)
                sets.extend(s[p[i]:p[i + 1]] for i in range(len(o) - 1))
        found: list[tuple[int, int]] = []
        for i, near in _partners(table, percent, sift):
            near = near[np.argmax(bands[near] == bands[i], axis=1) == band[i]] if len(near) else near
            for at in range(0, len(near), TOGETHER):
                some = near[at:at + TOGETHER]
                some = some[comp[some] != comp[i]]
                for j in some[_linked_all(sets[i], [sets[j] for j in some], percent)]:
                    if comp[j] != comp[i]:
                        found.append((node[i], node[j]))
                        comp[comp == comp[j]] = comp[i]
        a, b = (np.array([p[x] for p in found], dtype=np.int64) for x in (0, 1))
        return pa.table({"a": a, "b": b})

    return task


def _dealt(members: DataFrame, blocks) -> DataFrame:
    """Every member of block i once for each block j of its bucket: as side 0 with j > i, as side 1 with j < i, as side 2 (within) with itself."""
    return (members.withColumn("i", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
            .withColumns({"side": F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1),
                          "i": F.least("i", "j"), "j": F.greatest("i", "j")}))


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """One row of ``texts`` for each of the distinct ``ids``.

    The ids are folded into a bit table of fixed size, which every task holds: texts that are not wanted are left out where
    they are read, and only the others (with few false ones, which the join drops) are shuffled."""
    cell = f"pmod(xxhash64(doc_id), {CELLS}L)"
    bits = ids.groupBy(F.expr(f"{cell} div 64").alias("_place")).agg(F.expr(f"bit_or(shiftleft(1L, cast({cell} % 64 as int)))").alias("_bits"))
    near = texts.withColumn("_place", F.expr(f"{cell} div 64")).join(F.broadcast(bits), "_place").where(F.expr(f"getbit(_bits, cast({cell} % 64 as int)) = 1"))
    return near.drop("_place", "_bits").join(ids, "doc_id").dropDuplicates(["doc_id"])


def _open_links(ajar: DataFrame, reps: DataFrame, texts: DataFrame, shingle: int, percent: int, sift: float) -> DataFrame:
    """Links within buckets of several components.  ``ajar``: bucket, band, n, doc_id, component."""
    kept = ["bucket", "doc_id", "component", "side", "i", "j"]
    tasks = int(ajar.sparkSession.conf.get("spark.sql.shuffle.partitions"))      # small rows, much work: not to be merged into a few tasks
    met = (_dealt(ajar, F.ceil(F.col("n") / BLOCK)).select(*kept).join(reps.select("doc_id", "n_shingles", "sketch"), "doc_id")
           .repartition(tasks, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(_sifted(percent, sift), "bucket bigint, doc_id bigint").distinct())
    met = stored(ajar.join(met, ["bucket", "doc_id"]).select("bucket", "band", "doc_id", "component"), "odd-met")
    wanted = stored(texts_of(texts, stored(met.select("doc_id").distinct(), "odd-met-ids")).withColumn("bytes", F.octet_length("text")), "odd-met-texts")
    blocks = (met.join(wanted.select("doc_id", "bytes"), "doc_id").groupBy("bucket")
              .agg(F.greatest(F.ceil(F.sum("bytes") / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK)).alias("blocks")))
    rows = (_dealt(met.join(blocks, "bucket"), F.col("blocks")).select(*kept, "band")
            .join(reps.select("doc_id", "n_shingles", "sketch", "bands"), "doc_id").join(wanted.select("doc_id", "text"), "doc_id"))
    return rows.repartition(tasks, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(_blocks(shingle, percent, sift), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (confirmed in the search) and kept for every row of ``docs``."""
    sift = SIFT - (0.8 - percent / 100)
    sig = stored(signatures(docs, shingle), "odd-signatures")
    full = sig.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "s1", "s2"]
    classes = stored(full.groupBy(*same).agg(F.min("doc_id").alias("rep")), "odd-classes")
    reps = stored(full.join(classes, same).filter("doc_id = rep").dropDuplicates(["doc_id"])
                  .select("doc_id", "n_shingles", "sketch", "bands"), "odd-reps")
    cells = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = (cells.groupBy("band", "key")
               .agg(F.count("*").alias("n"), F.min("doc_id").alias("hub"), F.bit_xor(F.xxhash64("doc_id")).alias("x"),
                    F.sum(F.xxhash64(F.lit(5), F.col("doc_id")).cast("decimal(38,0)")).alias("s"))
               .filter("n > 1").groupBy("n", "hub", "x", "s").agg(F.min(F.struct("band", "key")).alias("cell"))
               .select("n", "hub", F.col("cell.band").alias("band"), F.col("cell.key").alias("key"), F.xxhash64("cell.band", "cell.key").alias("bucket")))
    members = stored(cells.join(buckets, ["band", "key"]).select("bucket", "band", "n", "hub", "doc_id"), "odd-members")

    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("bigint"), "text")
    degree = members.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    middle = members.join(degree, "doc_id").groupBy("bucket").agg(F.max(F.struct("degree", F.negative("doc_id").alias("minus"))).alias("m"))
    centre = members.join(middle.select("bucket", F.negative("m.minus").alias("centre")), "bucket")
    stars = (centre.select(F.explode(F.array(F.struct(F.col("hub").alias("h"), F.col("doc_id").alias("d")),
                                             F.struct(F.col("centre").alias("h"), F.col("doc_id").alias("d")))).alias("p"))
             .filter("p.h != p.d").select(F.least("p.h", "p.d").alias("a"), F.greatest("p.h", "p.d").alias("b")).distinct())
    sk = reps.select("doc_id", "sketch")
    near = (stars.join(sk.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a")
            .join(sk.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
            .filter(estimate("x", "y") >= sift).select("a", "b"))
    near = stored(near, "odd-near")
    wanted = stored(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "odd-wanted")
    rep_texts = stored(texts_of(texts, wanted), "odd-texts")
    links = (near.join(rep_texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
             .join(rep_texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
             .select("a", "b", "a_text", "b_text").mapInArrow(_confirm(shingle, percent), "a bigint, b bigint"))
    links = stored(links, "odd-links")

    # buckets of three or more that the stars have left in several components
    comp = stored(components(links), "odd-components") if links.take(1) else None
    placed = members.filter("n > 2")
    placed = (placed.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
              if comp is not None else placed.withColumn("component", F.col("doc_id")))
    placed = stored(placed, "odd-placed")
    ajar = stored(placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("bucket"), "odd-ajar")
    if ajar.take(1):
        more = _open_links(placed.join(ajar, "bucket"), reps, texts, shingle, percent, sift)
        links = stored(links.unionByName(more).distinct(), "odd-links")
        comp = stored(components(links), "odd-components") if links.take(1) else None

    out = sig.join(classes, same, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    if comp is not None:
        per_node = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        out = out.join(comp.join(per_node, "node", "left"), out["rep"] == comp["node"], "left").drop("node")
    else:
        out = out.withColumns({"component": F.lit(None).cast("bigint"), "n_links": F.lit(0).cast("bigint")})
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
