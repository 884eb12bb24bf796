"""Repeated windows over a whole table, found through winnowed anchors.

Shared by the word (seed_extend) and byte (column_bwt) operators.  Every window of
``length`` symbols selects one of its ``k``-grams, the smallest hash; equal windows select
equal k-grams at equal offsets.  Neighbouring windows that select one occurrence form a *run*, so a
text yields about 2/(length-k+2) runs per symbol instead of a row per window.  Two runs with the
same anchor and the same extended text (both ends of all their windows) agree in
every window: that settles the inside of a repeated passage by one comparison a run.
Only runs whose anchor also stands in *another* extended text (the ends of repeated
passages) have to be compared window by window, which is the caller's extension step.

A passage that a third of all documents share is collapsed inside each task
before the shuffle: of equal runs in one Arrow batch only the first is dealt by
its anchor, the others are settled on the spot and dealt evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.textkit import _A, hash_words, mix, prefix, rolled, signed, slices, stored, winnow, words

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _A)
# a run on its way through the shuffle: 48 bits of the anchor's hash; 48 bits of its text's, the anchor's place in the
# run, the window count (both under 64) and the done mark; the start
_RUN = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32())])
RUN_DDL = "anchor bigint, ctx bigint, doc_id bigint, pos int"
MAX_SPREAD = 63              # windows of a run; longer settled stretches are split


def word_symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, off)
    return hash_words(data, starts, ends), first


def byte_symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _BYTE[data], off


def window_starts(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of every window of ``length`` symbols that stays in its document, and that document."""
    count = np.maximum(np.diff(bounds) - length + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    before = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=before[1:])
    return np.arange(before[-1]) - before[:-1][doc] + bounds[:-1][doc], doc


def _runs(x: np.ndarray, bounds: np.ndarray, length: int, k: int) -> list[np.ndarray]:
    at, doc = window_starts(bounds, length)
    if not len(at):
        return []
    sums = prefix(x)
    g = mix(rolled(sums, slice(0, len(x) - k + 1), k))
    sel = winnow(g, at, length - k + 1)
    head = np.ones(len(sel), dtype=bool)
    head[1:] = sel[1:] != sel[:-1]
    r0 = np.flatnonzero(head)
    r1 = np.append(r0[1:], len(sel)) - 1
    lo, hi, a = at[r0], at[r1], sel[r0]
    shape = ((a - lo) * length + hi - lo).astype(np.uint64)
    ctx = mix(mix(rolled(sums, lo, length) * _A + shape) + rolled(sums, hi, length))
    return [g[a] >> np.uint64(16), ctx >> np.uint64(16), doc[r0], lo - bounds[:-1][doc[r0]], hi - lo + 1, a - lo]


def _settle(anchor, ctx, doc, pos, n, place, same_doc: bool) -> list[np.ndarray]:
    """Mark the rows that equal an earlier one of this batch and join neighbouring marked rows of a document."""
    order = np.lexsort((pos, doc, ctx, anchor))
    anchor, ctx, doc, pos, n, place = (v[order] for v in (anchor, ctx, doc, pos, n, place))
    head = np.ones(len(doc), dtype=bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (ctx[1:] != ctx[:-1])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    done = (doc != doc[lead]) | (pos != pos[lead]) if same_doc else doc > doc[lead]
    d, p, m = doc[done], pos[done], n[done]
    order = np.lexsort((p, d))
    d, p, m = d[order], p[order], m[order]
    if len(d):
        # runs of a document do not overlap; stretches begin anew where there is a gap or the count would not fit
        gap = np.ones(len(d), dtype=bool)
        gap[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + m[:-1])
        far = p - p[np.flatnonzero(gap)][np.cumsum(gap) - 1]
        per = max(1, MAX_SPREAD - int(m.max()))
        cut = gap.copy()
        cut[1:] |= far[1:] // per != far[:-1] // per
        s = np.flatnonzero(cut)
        e = np.append(s[1:], len(d)) - 1
        d, p, m = d[s], p[s], p[e] + m[e] - p[s]
    spread = mix(d.view(np.uint64) * _A + p.astype(np.uint64) + np.uint64(1)) >> np.uint64(16)
    live = ~done
    ctx = (ctx[live] << np.uint64(16)) | (place[live].astype(np.uint64) << np.uint64(7)) | (n[live].astype(np.uint64) << np.uint64(1))
    settled = (spread << np.uint64(16)) | (m.astype(np.uint64) << np.uint64(1)) | np.uint64(1)
    return [signed(np.concatenate([anchor[live], spread])), signed(np.concatenate([ctx, settled])),
            np.concatenate([doc[live], d]), np.concatenate([pos[live], p]).astype(np.int32)]


def _run_task(symbols, length: int, k: int, same_doc: bool):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            parts = []
            for rows, data, off in slices(batch):
                x, bounds = symbols(data, off)
                got = _runs(x, bounds, length, k)
                if got:
                    got[2] = rows.column(0).to_numpy(zero_copy_only=False)[got[2]]
                    parts.append(got)
            if parts:
                cols = _settle(*[np.concatenate(c) for c in zip(*parts)], same_doc)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=_RUN)

    return task


def repeated_runs(docs: DataFrame, symbols, length: int, k: int, same_doc: bool) -> DataFrame:
    """Stored table (doc_id, pos, n, covered, anchor, place, crowd) of the runs that matter.

    ``covered``: every window of the run starts earlier elsewhere (with ``same_doc`` also earlier in
    the same document, else in a smaller doc_id).  The others are first of their
    extended text, while their anchor (``place`` symbols into the run, in ``crowd`` runs) stands in another one too."""
    runs = docs.select("doc_id", "text").mapInArrow(_run_task(symbols, length, k, same_doc), RUN_DDL)
    key = Window.partitionBy("anchor")
    text = Window.partitionBy("anchor", "ctx").orderBy("doc_id", "pos")
    first = (F.rank().over(text) > 1) if same_doc else (F.col("doc_id") > F.first("doc_id").over(text))
    out = (runs.withColumn("later", first)
           .withColumns({"open": F.min("ctx").over(key) != F.max("ctx").over(key), "crowd": F.count("*").over(key)})
           .withColumn("covered", (F.col("ctx").bitwiseAND(F.lit(1)) == 1) | F.col("later")).filter("covered or open"))
    only = lambda c: F.when(~F.col("covered"), c)
    return stored(out.select("doc_id", "pos", F.shiftright("ctx", 1).bitwiseAND(F.lit(63)).cast("int").alias("n"), "covered",
                             only(F.col("anchor")).alias("anchor"), only(F.shiftright("ctx", 7).bitwiseAND(F.lit(63)).cast("int")).alias("place"),
                             only(F.col("crowd")).alias("crowd")), "runs")


def spans_of(rows: DataFrame) -> DataFrame:
    """(doc_id, spans): start (upper half) and window count of all runs of a document; bounded by its length."""
    return rows.groupBy("doc_id").agg(F.collect_list(F.shiftleft(F.col("pos").cast("bigint"), 32).bitwiseOR(F.col("n").cast("bigint"))).alias("spans"))


def covered_mask(size: int, pos: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Symbols of a text covered by windows ``pos`` .. ``pos+n-1``; windows beyond the text do not count."""
    edge = np.zeros(size + 1, dtype=np.int32)
    end = np.minimum(pos + n - 1 + length, size)
    ok = pos < end
    np.add.at(edge, pos[ok], 1)
    np.add.at(edge, end[ok], -1)
    return np.cumsum(edge[:-1]) > 0


def span_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, starts and counts of a column of spans; null lists are empty."""
    size = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    off = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=off[1:])
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return off, flat >> 32, flat & 0xFFFFFFFF
