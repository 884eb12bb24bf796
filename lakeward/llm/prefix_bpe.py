"""BPE encoding by dynamic programming over prefixes, and decoding.

Byte-pair encoding applies merges by rank until none is left.  Two facts make that a
dynamic program.  A sequence of tokens is the encoding of its text if and only if each token encodes
itself and each neighbouring pair is compatible, that is, encodes the pair's joined text.  And an
encoding without its last token is the encoding of the shorter text.  So every
prefix of a word has exactly one last token: of the tokens that are suffixes of the prefix
(an automaton over the vocabulary lists them), the one compatible with the last token
of the prefix before it.  Back-pointers from the end then give the ids, in time linear in
the word whatever it holds; the merges are never replayed.

Compatibility of a pair undoes the merges of both tokens from the latest rank down and looks
whether the two symbols that meet at the border would have merged earlier; of equal ranks the leftmost merge goes first.

The file's normalizer, its pieces (a merge never crosses a piece) and its special
tokens are applied first.  Words recur, so each distinct word is encoded once in a
Python worker and looked up afterwards; tables of words and pairs are emptied beyond a bound.
Tasks work on slices of whole documents without a shuffle; a lost task is simply run again.

Files: BPE over the byte-level alphabet, with or without an end-of-word suffix, whose normalizer and
pre-tokenizer let nothing cross white space and drop it; any other file is refused.

Defined cases: a null or empty text, or one of white space alone, has no ids and decodes to the empty string; null doc_ids
and repeated rows are encoded like any row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import hash_words, slices, words

KNOWN_WORDS = 1 << 20        # distinct words, and pairs of tokens, that a Python worker remembers
_END = 0x400                 # added to a piece's last symbol where the vocabulary marks word ends

# fixed value: how the supported files cut pieces; for ASCII text the pattern below gives the same pieces
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PLAIN = re.compile(r"[!-~]+")

OUT_DDL = "doc_id bigint, n_tokens bigint, ids binary, decoded string"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


class Merges:
    """Vocabulary and merges of a file: which tokens encode themselves, which pairs are compatible, and the automaton."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE models are supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        n = max(vocab.values()) + 1
        self.rank, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.merge: dict[tuple[int, int], int] = {}                  # pair -> rank
        for r, (a, b) in enumerate(pairs):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if self.rank[t] >= 0 or max(self.rank[x], self.rank[y]) >= r:
                raise ValueError("a token with two merges, or one merged before its parts")
            self.rank[t], self.left[t], self.right[t], self.merge[x, y] = r, x, y, r
        self.size, self.known = [0] * n, {}
        self.automaton = ahocorasick.Automaton()
        symbols = {t: self.symbols(s) for s, t in vocab.items()}
        itself = [False] * n
        for t in sorted(symbols, key=lambda t: self.rank[t]):
            x, y = self.left[t], self.right[t]
            itself[t] = (len(symbols[t]) == 1) if x < 0 else itself[x] and itself[y] and self._meet(x, y, self.rank[t])
            if itself[t]:
                self.size[t] = len(symbols[t])
                self.automaton.add_word(symbols[t], t)
        self.automaton.make_automaton()

    def symbols(self, token: str) -> str:
        """One character a symbol: a letter with the end-of-word suffix is one symbol of its own."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + _END)
        return token

    def _meet(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of a rank below ``limit`` joins symbols of both tokens while they are built side by side."""
        rank, merge = self.rank, self.merge
        while True:
            got = merge.get((a, b))
            if got is not None and got < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif rank[b] >= 0:                     # of equal ranks the left one was merged first
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        got = self.known.get((a, b))
        if got is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            got = self.known[a, b] = self._meet(a, b, len(self.rank))
        return got

    def encode(self, piece: str) -> list[int]:
        """Ids of one piece, given in the byte-level alphabet."""
        if self.suffix:
            piece = piece[:-1] + chr(ord(piece[-1]) + _END)
        last, size = [-1] * (len(piece) + 1), self.size
        for end, token in self.automaton.iter(piece):
            end += 1
            if last[end] < 0:
                begin = end - size[token]
                if not begin or (last[begin] >= 0 and self.compatible(last[begin], token)):
                    last[end] = token
        at, out = len(piece), []
        while at:
            token = last[at]
            if token < 0:
                raise ValueError("a symbol that the vocabulary does not hold")
            out.append(token)
            at -= size[token]
        return out[::-1]


class Coder:
    """Encodes and decodes whole slices of documents with one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cuts = spec["pre_tokenizer"] if spec["pre_tokenizer"]["type"] == "Sequence" else {"pretokenizers": []}
        split = [c["pattern"].get("Regex") for c in cuts["pretokenizers"] if c["type"] == "Split" and c["behavior"] == "Removed" and c["invert"]]
        lower = any(c["type"] == "Lowercase" for c in (spec["normalizer"] or {}).get("normalizers", []))
        if split != [PIECES] or not lower or spec["decoder"]:
            raise ValueError("only lower-casing files whose pieces never hold white space, without a decoder, are supported")
        self.file = Tokenizer.from_file(path)          # its normalizer and its cut into pieces serve words beyond ASCII
        self.merges = Merges(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        token = {**{t: s for s, t in spec["model"]["vocab"].items()}, **{t: s for s, t in self.special.items()}}
        shown = [(token.get(t, "") + " ").encode() for t in range(max(token) + 1)]
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)        # every token as decoded, with the space that follows it
        self.shown_size = np.array([len(x) for x in shown], dtype=np.int64)
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.forget()

    def forget(self) -> None:
        self.hash, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)     # words by hash, and each one's entry
        self.ids, self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.piece: dict[str, list[int]] = {}

    def _pieces(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _ASCII.findall(text.lower())
        return [p for p, _ in self.file.pre_tokenizer.pre_tokenize_str(self.file.normalizer.normalize_str(text))]

    def word_ids(self, word: str) -> list[int]:
        out: list[int] = []
        for part in self.special_at.split(word) if self.special_at and any(s in word for s in self.special) else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece in self._pieces(part):
                    got = self.piece.get(piece)
                    if got is None:
                        got = self.piece[piece] = self.merges.encode(piece)
                    out += got
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents and, per document, the index of its first (one more entry than documents)."""
        if max(len(self.hash), len(self.piece)) > KNOWN_WORDS:
            self.forget()
        starts, ends, first = words(data, off)
        hashes, one, back = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(hashes, self.hash, assume_unique=True))
        if len(new):
            raw = data.tobytes()
            found = [self.word_ids(raw[a:b].decode()) for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())]
            size = np.array([len(x) for x in found], dtype=np.int64)
            where = np.searchsorted(self.hash, hashes[new])
            self.hash = np.insert(self.hash, where, hashes[new])
            self.entry = np.insert(self.entry, where, len(self.size) + np.arange(len(new)))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, np.array([i for x in found for i in x], dtype=np.uint32)])
        entry = self.entry[np.searchsorted(self.hash, hashes)][back]
        ids, bound = _gathered(self.ids, self.at[entry], self.size[entry])
        return ids, bound[first]

    def decode(self, ids: np.ndarray, bound: np.ndarray) -> pa.Array:
        """Texts of the documents' ids: the tokens as the vocabulary spells them, a space between two."""
        flat, at = _gathered(self.shown, self.shown_at[ids], self.shown_size[ids])
        some = np.diff(bound) > 0
        keep = np.ones(len(flat), dtype=bool)
        keep[at[bound[1:][some]] - 1] = False              # no space after a document's last token
        off = np.zeros(len(bound), dtype=np.int64)
        np.cumsum(np.diff(at[bound]) - some, out=off[1:])
        return pa.Array.from_buffers(pa.large_string(), len(bound) - 1, [None, pa.py_buffer(off), pa.py_buffer(flat[keep])]).cast(pa.string())


def _gathered(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[at:at + size]`` one after the other, and where each begins (one more entry than runs)."""
    bound = np.zeros(len(at) + 1, dtype=np.int64)
    np.cumsum(size, out=bound[1:])
    return flat[np.arange(bound[-1]) + np.repeat(at - bound[:-1], size)], bound


def worker_coder(path: str) -> Coder:
    """The coder of this Python worker, kept from task to task; a word's ids do not depend on the task."""
    import sys
    from types import ModuleType

    kept = sys.modules.setdefault("_lakeward_coders", ModuleType("_lakeward_coders")).__dict__
    if path not in kept:
        kept[path] = Coder(path)
    return kept[path]


def _task(path: str):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(path)
        for batch in it:
            for rows, data, off in slices(batch):
                ids, bound = coder.encode(data, off)
                raw = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(4 * bound), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(bound)), raw, coder.decode(ids, bound)], schema=_OUT)

    return task


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text decoded from them."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_task(tokenizer_path), OUT_DDL)
