"""Texts as arrays of word hashes, a bounded group of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

GROUP_BYTES = 2 << 20
PUNCTUATION = ".,;:!?\"'()[]{}<>*_`~-"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts (bytes), and words per text.

    A word counts without case (A-Z) and without punctuation at its ends. Each distinct word of the array is hashed once and
    none is kept, so that a worker holds no vocabulary.
    """
    plain = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    split = pc.ascii_split_whitespace(plain)
    table = split.flatten().dictionary_encode()
    core = pc.ascii_trim(pc.ascii_lower(table.dictionary), PUNCTUATION)
    core = pc.if_else(pc.equal(pc.binary_length(core), 0), table.dictionary, core).cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, core), np.uint64, len(core))
    word = table.indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    real = np.fromiter(map(bool, core), bool, len(core))[word]  # white space at an end leaves an empty piece
    return hashes[word[real]], np.bincount(text[real], minlength=len(texts))


class Group:
    """Some texts in a row: ``rows`` of the batch, ``tokens`` of all, ``text`` and ``at`` (place in its text) of each token."""

    def __init__(self, rows: np.ndarray, tokens: np.ndarray, counts: np.ndarray):
        self.rows, self.tokens, self.counts = rows, tokens, counts
        self.starts = np.cumsum(self.counts) - self.counts
        self.text = np.repeat(np.arange(len(rows)), self.counts)
        self.at = np.arange(len(self.tokens)) - self.starts[self.text]

    def inside(self, span: int) -> np.ndarray:
        """Tokens at which a window of ``span`` stays within its text."""
        return self.at + span <= self.counts[self.text]


def groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[Group]:
    """The texts (bytes) of a batch in groups of about ``limit`` bytes; a longer text is a group of its own."""
    part = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(texts)]
    for start, stop in zip(cuts.tolist(), cuts[1:].tolist()):
        if stop > start:
            yield Group(np.arange(start, stop), *word_hashes(texts[start:stop]))
    pa.default_memory_pool().release_unused()  # a worker waits for its next task, or another one works


def window_hash(tokens: np.ndarray, keep: list[int], seed: int = 0) -> np.ndarray:
    """Hash of the tokens at the offsets ``keep`` of every window; the last windows of the array are cut off."""
    span = keep[-1] + 1
    n = len(tokens) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, 0x9E3779B97F4A7C15 * (2 * seed + 1) & (1 << 64) - 1, np.uint64)
        for offset in keep:
            total = (total ^ tokens[offset : offset + n]) * np.uint64(0x9FB21C651E98DF25)
            total ^= total >> np.uint64(29)
    return total
