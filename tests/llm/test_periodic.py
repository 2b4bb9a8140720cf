"""Periodic runs against the definition, the planted tail, digests and the defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from folio.llm import periodic as P


def brute(ids):
    """Every run by the definition: each period q, maximal stretches, smallest period."""
    ids = np.asarray(ids, dtype=np.int64)
    n, out = len(ids), set()
    for q in range(1, n // 2 + 1):
        for s, e in P._stretches(ids[:-q] == ids[q:], max(12, 2 * q) - q):
            length = e - s + q
            if not any(np.array_equal(ids[s : s + length - d], ids[s + d : s + length]) for d in range(1, q) if q % d == 0):
                out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2], r[1]))


def planted(rnd, n, k):
    ids = [rnd.randrange(k) for _ in range(n)]
    for _ in range(rnd.randint(0, 4)):
        q = rnd.randint(1, max(1, n // 3))
        a = rnd.randint(0, n - 1)
        if rnd.random() < 0.3:
            ids[a : a + q - 1] = [7] * len(ids[a : a + q - 1])
        for i in range(a + q, min(n, a + rnd.randint(q, 4 * q))):
            ids[i] = ids[i - q]
    return ids


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        ids = planted(rnd, rnd.randint(0, 1500), rnd.choice([2, 3, 5, 30, 1000]))
        assert P.find_runs(np.array(ids, dtype=np.int64)) == brute(ids)


@pytest.mark.parametrize("q", [17, 33, 100, 257])
def test_unit_that_is_itself_periodic(q):
    ids = ([0] * (q - 1) + [1]) * 3 + [5, 6, 7]
    assert P.find_runs(np.array(ids)) == brute(ids)


def test_planted_tail_follows_the_rule():
    words = [f"w{i}" for i in range(100)]
    doc_id = next(d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % 100
    p = 1 + (100 - a) // (3 + g % 8)
    out = P.perturb(words, doc_id)
    assert out[:a] == words[:a] and all(out[i] == words[a + (i - a) % p] for i in range(a, 100))
    assert P.perturb(words, doc_id + 1 if zlib.crc32(str(doc_id + 1).encode()) % 10 else doc_id + 2) == words


def test_describe_digests():
    words = "a b c".split() + ["x", "y"] * 10 + ["z"]
    n_runs, start, length, period, milli, runs_sha, collapsed_sha = P.describe(words)
    assert (n_runs, start, length, period, milli) == (1, 3, 20, 2, 10000)
    assert runs_sha == hashlib.sha256(b"3,20,2\n").hexdigest()
    assert collapsed_sha == hashlib.sha256("a b c x y z".encode()).hexdigest()
    none = P.describe([])
    assert none[:5] == (0, None, None, None, None) and none[6] == hashlib.sha256(b"").hexdigest()


def test_query_rows_and_defined_cases(spark):
    rows = [(1, "a b " * 20), (1, "a b " * 20), (2, None), (3, ""), (None, "x " * 13), (5, "q" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("period", P.F.lit(1))
    got = {(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"]) for r in P.periodic_runs(docs).collect()}
    assert got == {(1, 1, 0, 40, 2), (2, 0, None, None, None), (3, 0, None, None, None), (None, 1, 0, 13, 1), (5, 0, None, None, None)}
    assert P.periodic_runs(docs.limit(0)).count() == 0
