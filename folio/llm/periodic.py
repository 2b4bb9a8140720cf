"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal), length at least
max(12, 2q), that no neighbouring word extends with period q. Runs are found per document, inside the
task that reads it (no shuffle), in three steps:

1. **Highly periodic regions.** Periods up to ``SMALL`` are tested directly: one vector comparison of
   the word ids with themselves shifted by q.
2. **Synchronising positions at dyadic scales.** Periods in [P, 2P), P = 16, 32, 64, ..., are proposed
   by positions chosen by hash: every context (the c = P/4 words from a position) gets a 64-bit
   rolling hash, and a position is selected when its hash is the minimum of some window of c
   consecutive contexts. The choice depends only on nearby words, so inside a run of period q a selected
   position i has a selected twin i + q with an equal context: pairs of selected positions with equal
   contexts (each with its next ``NEIGHBOURS`` equal ones) propose their distance. Contexts that lie in
   an already found run of period at most c/2 are left out, which keeps equal contexts apart. Starts and
   ends of runs already found, of equal period and equal first words, propose their distances too: they
   supply periods whose synchronising positions were left out for lying in a periodic region.
3. **Verification.** Every proposed period is checked exactly over the whole document: maximal stretches
   of equal words q apart give the runs; a stretch that also has a period q/r (r a prime factor of q)
   is not a run of period q.

Every reported run is exact; a run is reported if its period was proposed, which the brute-force tests
(``tests/llm/test_periodic.py``) check against the definition on random and planted texts.

Defined cases: a null text has no words; an empty table gives no rows; every input row gives one row
(repeated rows repeat); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values of the definition of a run, and of the search
MIN_LENGTH = 12
SMALL = 16
NEIGHBOURS = 32

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def _stretches(eq: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Maximal [s, e) where ``eq`` is true, of at least ``need`` entries."""
    if eq.size == 0:
        return []
    padded = np.concatenate(([False], eq, [False])).astype(np.int8)
    edges = np.flatnonzero(np.diff(padded))
    starts, ends = edges[0::2], edges[1::2]
    keep = ends - starts >= need
    return list(zip(starts[keep].tolist(), ends[keep].tolist()))


def _prime_factors(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    if q > 1:
        out.append(q)
    return out


class _Doc:
    """Word ids of one document and the runs of verified periods."""

    def __init__(self, ids: np.ndarray):
        self.w = ids
        self.n = ids.size
        self._mismatch: dict[int, np.ndarray] = {}
        self.runs: set[tuple[int, int, int]] = set()
        self.tried: set[int] = set()

    def mismatches(self, d: int) -> np.ndarray:
        """Prefix sums of positions i with w[i] != w[i + d]."""
        if d not in self._mismatch:
            self._mismatch[d] = np.concatenate(([0], np.cumsum(self.w[:-d] != self.w[d:])))
        return self._mismatch[d]

    def has_period(self, start: int, length: int, d: int) -> bool:
        m = self.mismatches(d)
        return m[start + length - d] - m[start] == 0

    def verify(self, q: int) -> None:
        if q in self.tried or q < 1 or 2 * q > self.n or max(MIN_LENGTH, 2 * q) > self.n:
            return
        self.tried.add(q)
        need = max(MIN_LENGTH, 2 * q) - q
        eq = self.w[:-q] == self.w[q:]
        if np.count_nonzero(eq) < need:
            return
        factors = _prime_factors(q)
        for s, e in _stretches(eq, need):
            length = e - s + q
            if not any(self.has_period(s, length, q // r) for r in factors):
                self.runs.add((s, length, q))


_BASE = 0x9E3779B97F4A7C15
_KEYS = np.random.default_rng(20240601).integers(1, 2**63, size=1 << 16, dtype=np.uint64) | np.uint64(1)


class _Hasher:
    """Prefix sums of word keys times powers of an odd base, so the hash of every context of c words is one subtraction.

    Word ids index a fixed table of random keys (modulo its size); equal hashes of unequal contexts only
    propose periods that verification then rejects.
    """

    def __init__(self, ids: np.ndarray):
        n = ids.size
        with np.errstate(over="ignore"):
            powers = np.full(n + 1, _BASE, dtype=np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            inverse = np.full(n + 1, pow(_BASE, -1, 2**64), dtype=np.uint64)
            inverse[0] = 1
            self.inverse = np.cumprod(inverse, dtype=np.uint64)
            keys = _KEYS[ids & (_KEYS.size - 1)]
            self.prefix = np.concatenate(([np.uint64(0)], np.cumsum(keys * powers[:n], dtype=np.uint64)))
        self.n = n

    def contexts(self, c: int) -> np.ndarray:
        m = self.n - c + 1
        with np.errstate(over="ignore"):
            return (self.prefix[c : c + m] - self.prefix[:m]) * self.inverse[:m]


def _sliding(h: np.ndarray, c: int, op: np.ufunc, fill: int) -> np.ndarray:
    """``op`` (minimum or maximum) of every window of ``c`` consecutive values, by blocks of prefix and suffix values."""
    m = h.size
    blocks = -(-m // c)
    padded = np.full(blocks * c, fill, dtype=np.uint64)
    padded[:m] = h
    grid = padded.reshape(blocks, c)
    prefix = op.accumulate(grid, axis=1).ravel()
    suffix = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(m - c + 1)
    return op(suffix[starts], prefix[starts + c - 1])


def _selected(h: np.ndarray, c: int) -> np.ndarray:
    """Positions whose context hash is the minimum of a window of ``c`` contexts that holds them.

    ``h[i]`` is at least the minimum of every window holding ``i``, so it is one of them exactly when it
    is at most the largest of those minima.
    """
    m = h.size
    if m <= c:
        return np.flatnonzero(h == h.min())
    top = np.iinfo(np.uint64).max
    mins = _sliding(h, c, np.minimum, top)
    around = np.concatenate((np.zeros(c - 1, dtype=np.uint64), mins, np.zeros(c - 1, dtype=np.uint64)))
    best = _sliding(around, c, np.maximum, 0)
    return np.flatnonzero(h <= best)


def _pairs(positions: np.ndarray, keys: np.ndarray, low: int, high: int) -> set[int]:
    """Distances in [low, high) between each position and its next NEIGHBOURS positions of equal key."""
    if positions.size < 2:
        return set()
    order = np.lexsort((positions, keys))
    p, k = positions[order], keys[order]
    found: set[int] = set()
    for step in range(1, NEIGHBOURS + 1):
        if step >= p.size:
            break
        same = k[step:] == k[:-step]
        d = p[step:] - p[:-step]
        good = same & (d >= low) & (d < high)
        found.update(d[good].tolist())
        if not same.any():
            break
    return found


def _boundary_proposals(doc: _Doc, low: int, high: int) -> set[int]:
    """Distances between starts (and ends) of found runs of equal period and equal first (last) words."""
    if len(doc.runs) < 2:
        return set()
    runs = np.array(sorted(doc.runs), dtype=np.int64)
    starts, lengths, periods = runs[:, 0], runs[:, 1], runs[:, 2]
    ends = starts + lengths
    head = np.array([hash(doc.w[s : s + q].tobytes()) for s, q in zip(starts, periods)], dtype=np.int64)
    tail = np.array([hash(doc.w[e - q : e].tobytes()) for e, q in zip(ends, periods)], dtype=np.int64)
    out = _pairs(starts, head * 1_000_003 + periods, low, high)
    out |= _pairs(ends, tail * 1_000_003 + periods, low, high)
    return out


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence of word ids, by start, then period."""
    doc = _Doc(np.asarray(ids, dtype=np.int64))
    n = doc.n
    for q in range(1, min(SMALL, n // 2) + 1):
        doc.verify(q)
    scale = SMALL
    hasher = _Hasher(doc.w) if 2 * scale <= n else None
    while 2 * scale <= n and scale <= n // 2:
        c = max(scale // 4, 1)
        if n >= c + 1:
            h = hasher.contexts(c)
            # contexts inside a found run of period <= c/2 are highly periodic: left out
            reach = np.full(n + 1, -1, dtype=np.int64)
            for s, length, q in doc.runs:
                if 2 * q <= c:
                    reach[s] = max(reach[s], s + length)
            reach = np.maximum.accumulate(reach)[: h.size]
            chosen = _selected(h, c)
            chosen = chosen[reach[chosen] < chosen + c]
            proposals = _pairs(chosen, h[chosen].view(np.int64), scale, 2 * scale)
            proposals |= _boundary_proposals(doc, scale, 2 * scale)
            for q in sorted(proposals):
                doc.verify(q)
        scale *= 2
    return sorted(doc.runs, key=lambda r: (r[0], r[2], r[1]))


def perturb(words: list[str], doc_id: int | None) -> list[str]:
    """The check's planted periodic tail: for h % 10 == 0, word i >= a becomes word a + (i - a) % p."""
    import zlib

    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def describe(words: list[str]) -> tuple:
    """Summary row of a document's words: runs, the longest, digests of all runs and of the collapsed text."""
    ids = pd.factorize(pd.Series(words, dtype=object))[0].astype(np.int64) if words else np.zeros(0, dtype=np.int64)
    runs = find_runs(ids)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        dropped[s + q] += 1
        dropped[s + length] -= 1
    keep = np.cumsum(dropped)[: len(words)] == 0
    collapsed = " ".join(w for w, k in zip(words, keep) if k) if runs else " ".join(words)
    if runs:
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        top = (s, length, q, (1000 * length) // q)
    else:
        top = (None, None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *top, sha(listing), sha(collapsed))


def _batches(batches: Iterator[pd.DataFrame], planted: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            did = None if pd.isna(doc_id) else int(doc_id)
            words = words_of(text if isinstance(text, str) else None)
            if planted:
                words = perturb(words, did)
            rows.append((did, *describe(words)))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")]).astype(
            {"n_runs": "int64", "start": "Int64", "length": "Int64", "period": "Int64", "exponent_milli": "Int64", "doc_id": "Int64"}
        )


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``.

    ``planted`` first applies the check's periodic tail (``perturb``) to the words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(lambda it: _batches(it, planted), SCHEMA)
