"""The packing tokenizer's tables of a Python worker are bounded and do not change ids."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakeward.llm import tier_packing


def test_parts_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(tier_packing, "KNOWN_PARTS", 100)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, whole = tier_packing.WordTokenizer(path), Tokenizer.from_file(path)
    texts = [" ".join(f"{a}{b}x{n}, {a}{b}'s" for a in "abcdefgh" for b in "klmnop") for n in ("y", "zz", "été")] * 2
    data = "".join(texts).encode()
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, bound = tok.encode(np.frombuffer(data, dtype=np.uint8), off, 1)
    assert len(tok.part) <= 100 < len(tok.known)
    for i, text in enumerate(texts):
        assert ids[bound[i]:bound[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids + [1]
