"""Whole-batch text primitives: words, hashes and windows as numpy arrays.

A batch of documents is handled as one byte buffer plus document offsets.
Words are maximal runs of bytes other than space and 0x09-0x0D, which equals
the pattern ``[^\\x20\\x09-\\x0D]+`` on the decoded text because UTF-8 never
uses those bytes inside a longer sequence.  Every hash is a pure function of
the bytes it covers, so tasks on different executors agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakeward.session import workspace

SLICE_BYTES = 2 << 20           # text handled at once inside a task; a longer document is a slice of its own
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_A = np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage and survives the loss of executors."""
    spark: SparkSession = df.sparkSession
    path = workspace(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most SLICE_BYTES of text (one row at least) with
    their UTF-8 bytes and document offsets; a null text counts as empty."""
    col = batch.column(batch.schema.get_field_index(text))
    col = pc.fill_null(col, "").cast(pa.large_binary())
    n, at = len(col), 0
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1, offset=8 * col.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, to - at), data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word and, per document, the index of its
    first word (one more entry than documents).  ``separators``: per byte value, whether it stands between words."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    heads = off[:-1][off[:-1] < off[1:]]
    after = before.copy()
    before[heads] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.append(inside, False)
    after[heads] = False
    after[len(data)] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, eight bytes a step."""
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) + _A)
    if not len(starts):
        return h
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    live, step = np.arange(len(starts)), 0
    while len(live):
        rest = size[live] - step
        v = eight[starts[live] + step]
        short = rest < 8
        keep = np.where(short, (np.uint64(1) << (np.minimum(rest, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1),
                        np.uint64(0xFFFFFFFFFFFFFFFF))
        h[live] = mix(h[live] * _A ^ (v & keep))
        step += 8
        live = live[rest > 8]
    return h


def window_hash(x: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbouring symbols, built by doubling."""
    out, width, done, power = None, 1, 0, x
    while True:
        if k & width:
            if out is None:
                out = power
            else:                           # ``out`` covers the first ``done`` symbols
                n = max(0, len(x) - done - width + 1)
                out = mix(out[:n] * _M2 + power[done:done + n])
            done += width
        if done == k:
            return out[:max(0, len(x) - k + 1)]
        power = mix(power[:-width] * _A + power[width:]) if len(power) > width else power[:0]
        width *= 2


_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse modulo 2^64; kept by the worker for slice-sized inputs."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(max(n, 1), base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    if n <= SLICE_BYTES + 1:
        _POWERS[:] = out
    return out[0], out[1]


def prefix(x: np.ndarray) -> np.ndarray:
    """Running sums of symbols times powers, from which ``rolled`` takes any window."""
    out = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x * _powers(len(x) + 1)[0][:len(x)], out=out[1:])
    return out


def rolled(sums: np.ndarray, at: np.ndarray | slice, k: int) -> np.ndarray:
    """Polynomial hash of the ``k`` symbols from each start; equal windows have equal hashes wherever they stand."""
    lo = sums[at]
    hi = sums[slice(at.start + k, at.stop + k)] if isinstance(at, slice) else sums[at + k]
    return (hi - lo) * _powers(len(sums))[1][at]


def winnow(g: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """For every start in ``valid`` the index of the smallest of the ``w``
    values of ``g`` from there, by their upper 40 bits (the last of equals)."""
    out, most = np.empty(len(valid), dtype=np.int64), 1 << 24
    for lo in range(0, len(g), most - w):                     # one pass unless a text is longer than 16M symbols
        part = g[lo:lo + most]
        low = (part & ~np.uint64(most - 1)) | (np.uint64(most - 1) - np.arange(len(part), dtype=np.uint64))
        width = 1
        while 2 * width <= w:
            low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
            width *= 2
        here = (valid >= lo) & (valid < lo + most - w) if len(g) > most - w else slice(None)
        v = valid[here] - lo
        best = np.minimum(low[v], low[v + w - width])
        out[here] = lo + (most - 1) - (best & np.uint64(most - 1)).astype(np.int64)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def strings(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.string())


def as_batches(iterator: Iterator[pa.RecordBatch], fn, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Apply ``fn(rows, bytes, offsets) -> list of arrays`` to every slice."""
    for batch in iterator:
        for rows, data, off in slices(batch):
            cols = fn(rows, data, off)
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], schema=schema)
