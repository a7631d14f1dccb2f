"""Memory of a block of the language model."""

import tracemalloc

import numpy as np
import pyarrow as pa

from pageloom.llm import lm_scoring
from pageloom.llm.common import hashed_words
from pageloom.llm.lm_scoring import Block


def _texts():
    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in rng.integers(0, 50_000, 700_000)]
    return [" ".join(words[n : n + 700]) for n in range(0, len(words), 700)] + ["", " "]


def test_block_memory_follows_its_tokens():
    texts = _texts()
    table = pa.table({"doc_id": range(len(texts)), "held_out": [False] * len(texts), "text": texts})
    tracemalloc.start()
    block = Block(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    tokens = int(block.sizes.sum())
    assert tokens == 700_000 + len(texts)
    assert peak < 160 * tokens

    hashes, sizes = hashed_words(pa.array(texts, pa.large_string()))
    assert (block.sizes == sizes + 1).all()
    ends = np.cumsum(block.sizes) - 1
    inner = np.delete(block.grams[1][block.place[1]], ends)
    assert (inner == hashes).all()


def test_spans_are_whole_documents(monkeypatch):
    monkeypatch.setattr(lm_scoring, "_STEP", 10)
    texts = ["a " * 4, "", "b " * 30, "c " * 4, "d " * 4, "e"]
    table = pa.table({"doc_id": range(6), "held_out": [False] * 6, "text": texts})
    block = Block(table)
    spans = [(s.start, s.stop) for s in block.spans()]
    assert spans == [(0, 6), (6, 37), (37, 47), (47, 49)]
