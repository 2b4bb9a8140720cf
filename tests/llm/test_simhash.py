import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folio.llm import simhash
from folio.llm.components import connected_components


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", "One", "one TWO three", "a b c d", "a b c d e f g É é Ü  x\ty\x0bz", "x " * 500])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text.encode()) == by_hand(text)


def test_spark_hash_is_the_same(spark):
    text = "Some words to hash"
    got = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_segments_leave_one_with_at_most_one_bit():
    for bits in range(8):
        parts = simhash.segments(bits)
        assert sum(w for _, w in parts) == 64 and bits // len(parts) <= 1


@pytest.mark.parametrize("block", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, block):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    for center in list(values)[:6]:  # dense groups and chains of near fingerprints
        at = center
        for _ in range(25):
            values.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
            at ^= sum(1 << b for b in rng.sample(range(64), 4))
            values.add(at)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), 4, block)
    pairs = found.collect()
    assert all(near(r["src"], r["dst"]) and r["src"] != r["dst"] for r in pairs)
    roots = {r["node"]: r["root"] for r in connected_components(found).collect()}
    want = [values[i] for i in classes(values, near)]
    assert [roots.get(v, v) for v in values] == want


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1001 + i) for i in range(5)] + [(500, 500)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(201)} == {0} and got[1005] == 1000


def test_groups_of_documents(spark):
    rng = random.Random(1)
    rows = []
    for d in range(40):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
        rows.append((d, " ".join(words)))
        if d % 2:
            rows.append((100 + d, " ".join(words)))
        if d % 4 == 0:
            words[150] = "changed"
            rows.append((200 + d, " ".join(words)))
    rng.shuffle(rows)
    got = {r["id"]: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ids = sorted(i for i, _ in rows)
    fps = [by_hand(dict(rows)[i]) for i in ids]
    want = classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert [got[i]["fp"] & (1 << 64) - 1 for i in ids] == fps
    assert [got[i]["component"] for i in ids] == [ids[j] for j in want]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({ids[j] for j in want})
