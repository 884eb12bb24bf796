"""Prefix-wise BPE against the tokenizers library itself: whole tables, awkward texts, generated texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from lakeward.llm.prefix_bpe import Coder, Merges, encode_documents
from lakeward.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    None, "", " \n\t ", "a", "<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|>", "<|EndOfText|> <|endoftext", "a" * 3000, "aaaaab" * 300,
    "İstanbul ΣΑΣ ﬁ é ́x  y z　w ​ q\x1cz", "日本語テキスト 한국어 👩‍👩‍👧 ½ ² ٣", "it's don'T WE'RE 'll'd ''s", "\x00\x01 \x7f",
    "1234567890" * 20, "!!!???..." * 50, "ab " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return tok


@pytest.fixture(scope="module")
def coder():
    return Coder(PATH)


def test_rows_equal_the_library(spark, library):
    """Nulls, empty and long texts, special tokens, a row given twice, a null doc_id and columns whose names the operator uses itself."""
    rnd = random.Random(5)
    texts = AWKWARD + ["".join(chr(rnd.randrange(1, 0xD7FF)) for _ in range(400)) for _ in range(20)]
    rows = [(i, t, b"x", "y", 7) for i, t in enumerate(texts)] + [(3, "a", b"", "", 1), (None, "null id", b"", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids binary, decoded string, n_tokens int").repartition(3, "doc_id")
    got = encode_documents(docs, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "null id" if r["doc_id"] is None else texts[r["doc_id"]]
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want), text
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_empty_table(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []


def test_query_equals_the_library_on_the_whole_table(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op12_prefix_bpe"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from([*"aehinorst'l1é ß<|>!Ä́\n", "the", "ing", "<|endoftext|>"]), max_size=60).map("".join))
def test_generated_texts(coder, library, text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ids, bound = coder.encode(data, np.array([0, len(data)], dtype=np.int64))
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert coder.decode(ids, bound).to_pylist() == [library.decode(want, skip_special_tokens=False)]


def replayed(word, merges):
    """Plain byte-pair encoding: the merge of the lowest rank, leftmost first, until none is left."""
    parts, rank = list(word), {p: i for i, p in enumerate(merges)}
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = ["".join(parts[i:i + 2])]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_any_merge_list(data):
    """Small random vocabularies, with tokens that never encode themselves, against replayed merges."""
    tokens, merges = list("abc"), []
    for _ in range(data.draw(st.integers(0, 12))):
        pair = (data.draw(st.sampled_from(tokens)), data.draw(st.sampled_from(tokens)))
        if "".join(pair) not in tokens:
            tokens.append("".join(pair))
            merges.append(pair)
    model = Merges({"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": [list(m) for m in merges]})
    for word in data.draw(st.lists(st.text(alphabet="abc", min_size=1, max_size=24), min_size=1, max_size=8)):
        assert [tokens[i] for i in model.encode(word)] == replayed(word, merges)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Coder(public_tokenizers.path("byte_bpe_50k.json"))
