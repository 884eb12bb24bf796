"""Substring dedup over words: seed and extend.

Winnowed anchors (see ``anchors``) join documents; a run of windows around an anchor is extended
both ways at once by comparing its whole extended text, and the runs at the ends
of a repeat are extended window by window.  The covered windows unite to the maximal repeats.

A window is ``length`` consecutive words of one document; it is covered if its word sequence also starts
earlier (smaller doc_id, or same document and earlier start).  Windows are judged on the input.

Defined cases: null or empty texts and texts shorter than a window lose nothing; a
repeated row (same doc_id and text) is one document and each row is returned alike; rows of
different texts must not share a doc_id (the spans of either apply to both); null doc_ids have no
order, so such rows neither lose words nor cover others'; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.anchors import covered_mask, repeated_runs, span_arrays, spans_of, window_starts, word_symbols
from lakeward.llm.textkit import _A, mix, prefix, rolled, signed, slices, words

WINDOW = 20
ANCHOR = 6                   # words of an anchor

_WIN = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("done", pa.bool_())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def open_windows(symbols, length: int, same_doc: bool):
    """(doc_id, text, spans) -> a row per window of the spans with a 128-bit hash; of
    windows that are equal within a batch all but the first are marked done."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            parts = []
            for rows, data, off in slices(batch):
                x, bounds = symbols(data, off)
                so, pos, n = span_arrays(rows.column(2))
                at, doc = window_starts(bounds, length)
                if not len(at) or not len(pos):
                    continue
                wanted = np.zeros(len(x) + 1, dtype=np.int32)
                span_doc = np.repeat(np.arange(len(so) - 1), np.diff(so))
                lo = np.minimum(bounds[:-1][span_doc] + pos, bounds[1:][span_doc])
                hi = np.minimum(lo + n, bounds[1:][span_doc])
                np.add.at(wanted, lo, 1)
                np.add.at(wanted, hi, -1)
                pick = (np.cumsum(wanted)[:-1] > 0)[at]
                at, doc = at[pick], doc[pick]
                parts.append((mix(rolled(prefix(x), at, length)), rolled(prefix(mix(x ^ _A)), at, length),
                              rows.column(0).to_numpy(zero_copy_only=False)[doc], at - bounds[:-1][doc]))
            if not parts:
                continue
            w1, w2, doc, pos = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((pos, doc, w2, w1))
            w1, w2, doc, pos = w1[order], w2[order], doc[order], pos[order]
            head = np.ones(len(doc), dtype=bool)
            head[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
            lead = np.flatnonzero(head)[np.cumsum(head) - 1] if len(doc) else np.zeros(0, np.int64)
            done = (doc != doc[lead]) | (pos != pos[lead]) if same_doc else doc > doc[lead]
            spread = mix(doc.view(np.uint64) * _A + pos.astype(np.uint64) + np.uint64(1))
            w1 = np.where(done, spread, w1)
            yield pa.RecordBatch.from_arrays([pa.array(signed(w1)), pa.array(signed(w2)), pa.array(doc), pa.array(pos.astype(np.int32)),
                                              pa.array(np.ones(len(doc), np.int32)), pa.array(done)], schema=_WIN)

    return task


def later_windows(docs: DataFrame, runs: DataFrame, symbols, length: int, same_doc: bool) -> DataFrame:
    """(doc_id, pos, n): windows of the open ``runs`` that start earlier elsewhere."""
    rows = (docs.join(spans_of(runs), "doc_id").select("doc_id", "text", "spans")
            .mapInArrow(open_windows(symbols, length, same_doc), "w1 bigint, w2 bigint, doc_id bigint, pos int, n int, done boolean"))
    w = Window.partitionBy("w1", "w2").orderBy("doc_id", "pos")
    later = (F.rank().over(w) > 1) if same_doc else (F.col("doc_id") > F.first("doc_id").over(w))
    return rows.withColumn("later", later).filter("done or later").select("doc_id", "pos", "n")


def _cut(length: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for rows, data, off in slices(batch):
                starts, ends, first = words(data, off)
                so, pos, n = span_arrays(rows.column(2))
                raw, kept, removed = data.tobytes(), [], np.zeros(len(off) - 1, dtype=np.int64)
                for i in range(len(off) - 1):
                    text = raw[off[i]:off[i + 1]].split()           # bytes split on exactly 0x20 and 0x09-0x0D
                    if so[i] < so[i + 1]:
                        gone = covered_mask(len(text), pos[so[i]:so[i + 1]], n[so[i]:so[i + 1]], length)
                        removed[i] = gone.sum()
                        text = [t for t, g in zip(text, gone.tolist()) if not g]
                    kept.append(b" ".join(text))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(removed),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], schema=_OUT)

    return task


def remove_repeats(docs: DataFrame, length: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    known, loose = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    runs = repeated_runs(known, word_symbols, length, anchor, True)
    gone = (runs.filter("covered").select("doc_id", "pos", "n")
            .unionByName(later_windows(known, runs.filter("not covered"), word_symbols, length, True)))
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    out = known.join(spans_of(gone), "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_cut(length), ddl)
    none = loose.select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("spans")).mapInArrow(_cut(length), ddl)
    return out.unionByName(none)
