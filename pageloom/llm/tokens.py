"""Token ids of whole texts, by the public word-level BPE vocabulary."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words whose ids a Python worker remembers.
REMEMBERED_WORDS = 600_000
# A letter before ASCII punctuation other than the apostrophe (which may begin a
# contraction) always ends a word of this vocabulary.
_WORD_END = r"(\pL)([!-&(-/:-@\[-`{-~])"
_MARKER = "<|"  # special tokens begin so


class WordTokenizer:
    """Equal to ``Tokenizer.encode(text, add_special_tokens=False)`` of the vocabulary.

    The vocabulary drops white space and never joins across it, so a text's ids are those
    of its white-space chunks in order. Each distinct chunk is encoded once. Texts that
    hold a special token's marker are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}
        self._reset()

    def forget(self) -> None:
        """Give back what the words of a task have taken."""
        self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # ends[i]: end of word i's ids
        self.starts = np.zeros(1 << 16, np.int64)
        self.filled = 0

    def _learn(self, words: list[str]) -> None:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        for word, code in zip(words, coded):
            ids = code.ids
            number, end = len(self.known), self.filled + len(ids)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(end, len(self.ids)), np.uint32)])
            if number == len(self.ends):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.ids[self.filled : end] = ids
            self.starts[number], self.ends[number] = self.filled, end
            self.filled = end
            self.known[word] = number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array and, per text, how many of them are its own."""
        lower = pc.replace_substring_regex(pc.ascii_lower(texts), _WORD_END, r"\1 \2")
        special = pc.match_substring(texts, _MARKER).to_numpy(zero_copy_only=False)
        if special.any():
            lower = pc.if_else(pa.array(special), texts, lower)
        lists = pc.ascii_split_whitespace(lower)
        row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(lists).dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) + len(words) > REMEMBERED_WORDS:
            self._reset()
        new = [word for word in words if word not in self.known]
        for at in range(0, len(new), 20_000):
            self._learn(new[at : at + 20_000])
        known = self.known
        number = np.fromiter((known[word] for word in words), np.int64, len(words))
        number = number[coded.indices.to_numpy(zero_copy_only=False)]
        start, size = self.starts[number], self.ends[number] - self.starts[number]
        total = int(size.sum())
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        ids = self.ids[shift + np.arange(total)]
        sizes = np.bincount(row, weights=size, minlength=len(texts)).astype(np.int64)
        return ids, sizes


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and vocabulary."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
