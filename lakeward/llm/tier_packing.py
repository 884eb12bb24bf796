"""Hierarchical multi-length packing.

Every document becomes token ids plus an end id and is routed to the smallest
context tier that holds it (a longer one is cut into whole windows of the
largest tier first).  Windows are opened from the longest tier down, one document or rest each;
the gap of a window is filled with the longest whole pieces of shorter tiers that
fit, and what is left of the gap with a cut piece, so windows are full.  At the end of a
partition the rest is cut into power-of-two sequences, which need no padding either.  Windows of the tiers are
interleaved evenly and dealt into step groups of equal token counts.

Packing runs in the task that tokenizes, over one input split at a time: no
shuffle, memory bounded by ``buffer`` tokens, and a rerun of a lost task
gives the same sequences, since split and order are those of the input files.

Tokens are found a distinct word at a time (the tokenizer splits at white space
anyway) and looked up for its repeats; words beyond plain Latin letters, digits and
punctuation, and those that may hold a special token, go through the whole tokenizer.

Defined cases: a null or empty text has the end id alone; null doc_ids and repeated rows are packed like any
row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import hash_words, slices, words

TIERS = (256, 512, 1024, 2048)
END_ID = 1
BUFFER_TOKENS = 1 << 20      # ids held before windows are formed
STEP_TOKENS = 1 << 16        # tokens of a step group
KNOWN_WORDS = 1 << 20        # words remembered by a Python worker, as numbers in arrays: 50 bytes a word
KNOWN_PARTS = 1 << 14        # parts of words remembered beside them, as Python objects of several hundred bytes

_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                  ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64())])
OUT_DDL = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_group bigint"

_PLAIN = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


class WordTokenizer:
    """Ids of whole documents by looking up the ids of their distinct words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]       # bytes the byte-level alphabet shows as themselves
        rest = [b for b in range(256) if b not in shown]
        self.byte = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)        # hashes of the words learnt, sorted, and the entry of each
        self.entry = np.zeros(0, dtype=np.int32)
        self.part: dict[str, list[int]] = {}
        self.flat = np.zeros(0, dtype=np.uint32)         # ids of all entries; each one's first place and count
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int32)

    def _ids(self, word: str) -> list[int]:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self.whole.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for p in _PARTS.findall(word.lower()):
            got = self.part.get(p)
            if got is None:
                got = [t.id for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.byte))]
                if len(self.part) >= KNOWN_PARTS:
                    self.part.clear()
                self.part[p] = got
            out += got
        return out

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        ids = [self._ids(t.decode("utf-8")) for t in texts]
        size = np.array([len(x) for x in ids], dtype=np.int64)
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, size.sum())])
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.entry = np.insert(self.entry, where, len(self.size) + np.arange(len(size), dtype=np.int32))
        self.size = np.concatenate([self.size, size.astype(np.int32)])

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents, each followed by ``end_id``, and where each document begins."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        starts, ends, first = words(data, off)
        uniq, one, back = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        where = np.searchsorted(self.known, uniq)
        new = np.ones(len(uniq), dtype=bool)
        inside = where < len(self.known)
        new[inside] = self.known[where[inside]] != uniq[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(uniq[new], [raw[a:b] for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
        word = self.entry[np.searchsorted(self.known, uniq)][back]
        size = self.size[word]
        before = np.zeros(len(word) + 1, dtype=np.int64)
        np.cumsum(size, out=before[1:])
        shift = np.arange(before[-1]) - np.repeat(before[:-1], size)
        ids = self.flat[np.repeat(self.at[word], size) + shift]
        bound = before[first] + np.arange(len(off))                 # an end id after every document
        out = np.empty(len(ids) + len(off) - 1, dtype="<u4")
        tail = np.zeros(len(out), dtype=bool)
        tail[bound[1:] - 1] = True
        out[tail], out[~tail] = end_id, ids
        return out, bound


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker, which keeps the words learnt from one task to the next.  What a word's ids
    are does not depend on the task, so a rerun elsewhere gives the same."""
    import sys
    from types import ModuleType

    kept = sys.modules.setdefault("_lakeward_worker", ModuleType("_lakeward_worker")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


def pack(sizes: list[int], tiers: tuple[int, ...], last: bool) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Windows (tier, [(item, start, length), ...]) for items of the given sizes, and the pieces left over unless ``last``."""
    top, windows = tiers[-1], []
    pool: list[tuple[int, int, int]] = []                            # (length, item, start), ascending
    for item, size in enumerate(sizes):
        whole = size // top * top
        windows += [(top, [(item, at, top)]) for at in range(0, whole, top)]
        if size > whole:
            pool.append((size - whole, item, whole))
    pool.sort()
    while pool:
        size, item, start = pool.pop()
        tier = tiers[bisect_left(tiers, size)]
        window, gap = [(item, start, size)], tier - size
        while gap and pool:
            at = bisect_right(pool, (gap, len(sizes), 0)) - 1
            if at >= 0:
                size, item, start = pool.pop(at)
                window.append((item, start, size))
                gap -= size
            else:                                                    # nothing fits whole: cut the shortest
                size, item, start = pool.pop(0)
                window.append((item, start, gap))
                insort(pool, (size - gap, item, start + gap))
                gap = 0
        if not gap:
            windows.append((tier, window))
        elif not last:
            return windows, window
        else:                                                        # the very end: power-of-two sequences
            rest = tier - gap
            while rest:
                room = 1 << (rest.bit_length() - 1)
                rest -= room
                own = []
                for n, (item, start, size) in enumerate(window):
                    take = min(size, room)
                    own.append((item, start, take))
                    room -= take
                    if not room:
                        window = ([(item, start + take, size - take)] if size > take else []) + window[n + 1:]
                        break
                windows.append((sum(x[2] for x in own), own))
    return windows, []


def interleaved(windows: list[tuple[int, list]]) -> list[tuple[int, list]]:
    """Windows of all tiers mixed evenly, so that every step group has the same mixture."""
    count, seen = {}, {}
    for tier, _ in windows:
        count[tier] = count.get(tier, 0) + 1
    key = []
    for i, (tier, _) in enumerate(windows):
        seen[tier] = seen.get(tier, 0) + 1
        key.append(((seen[tier] - 0.5) / count[tier], i))
    return [windows[i] for _, i in sorted(key)]


def _task(path: str, tiers: tuple[int, ...], end_id: int, buffer: int, step: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        tok = worker_tokenizer(path)
        held: list[tuple] = []           # (doc_id, doc_tokens, start of the held ids, ids)
        total, serial, spent = 0, 0, 0

        def flush(last: bool):
            nonlocal serial, spent, total
            windows, left = pack([len(h[3]) for h in held], tiers, last)
            rows = []
            for tier, window in interleaved(windows):
                offset = 0
                for item, start, size in window:
                    doc, tokens, begin, ids = held[item]
                    rows.append((doc, begin + start, size, ids[start:start + size].tobytes(), tokens, base + serial, offset, tier, base + spent // step))
                    offset += size
                serial += 1
                spent += offset
            held[:] = [(held[i][0], held[i][1], held[i][2] + s, held[i][3][s:s + n].copy()) for i, s, n in left]
            total = sum(len(h[3]) for h in held)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)

        for batch in it:
            for rows, data, off in slices(batch):
                ids, bound = tok.encode(data, off, end_id)
                for i, doc in enumerate(rows.column(0).to_pylist()):
                    own = ids[bound[i]:bound[i + 1]]
                    held.append((doc, len(own), 0, own))
                    total += len(own)
                if total >= buffer:
                    yield from flush(False)
            del batch, rows, data, off                   # before the next batch arrives
        if held:
            yield from flush(True)

    return task


def pack_documents(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
                   buffer_tokens: int = BUFFER_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, tier, step_group."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be ascending powers of two")
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _task(tokenizer_path, tuple(tiers), end_id, buffer_tokens, step_tokens), OUT_DDL)
