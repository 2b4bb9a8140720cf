import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folio.llm import secret_scan

# written in pieces, so that nothing here looks like a secret itself
KEY = "AKIA" + "QCN5VJTUYMSSXKC6"
MIXED = "Zk8" + "vQ1rT7pLw0XyB4nGdS9uJe"


def base(text):
    found = []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, m.end(), "hex"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found)), Counter(f[3] for f in found)


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in secret_scan.digest(secret_scan.scan(docs)).collect()}


def test_base_kinds(spark):
    rng = random.Random(1)
    pieces = ["password", "Token", "API_KEY", "apikey", "passwd", "secret", "=", ": ", " := ", '"', "'", "abc", "abcdef", "é", "漢😀", " ", "\n", KEY, "AKIA", "A1" * 9, "0123abcdef" * 3, "f" * 23, "/+x_.=-"]
    texts = ["", "secret=token = abcdefgh", "token token=abcdef", f"é😀 {KEY} x", None]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(400)]
    for i, r in scan(spark, texts).items():
        want, count = base(texts[i] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), texts[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (count["assign"], count["access"], count["hex"])
        kept = [s for s in r["spans"].split(",") if s and not s.startswith("entropy")]
        assert ",".join(kept) == want


@pytest.mark.parametrize("threshold", [2.0, 3.0, 3.6])
def test_windows_match_direct_entropy(spark, threshold):
    rng = random.Random(2)
    values = ["".join(rng.choices(secret_scan.ALPHABET[: rng.choice([2, 8, 16, 66])], k=rng.randint(20, 60))) for _ in range(60)]
    values += ["a" * 30 + MIXED + "a" * 30]

    def bits(window):
        return -sum(n / 20 * math.log2(n / 20) for n in Counter(window).values())

    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = frame.select("v", secret_scan.hot_range(F.col("v"), F.lit(threshold)).alias("r")).collect()
    for r in got:
        hot = [i for i in range(len(r["v"]) - 19) if bits(r["v"][i : i + 20]) >= threshold - 1e-9]
        want = (hot[0], hot[-1] + 20) if hot else (-1, -1)
        assert (r["r"]["start"], r["r"]["end"]) == want


def test_entropy_adds_and_the_allow_list_suppresses(spark):
    texts = [
        f"é key {MIXED} end",
        "a perfectlyordinarybutverylongwordwithoutdigits here",
        "id 123e4567-e89b-12d3-a456-426614174000 here",
        f"sha256: {MIXED}",
        f"password={MIXED}",
        "2024-01-02-report-final-version-3",
        "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1",
        "abcdefghijklmnopqrstuvwxyz0123456789",
    ]
    got = scan(spark, texts)
    assert got[0]["spans"] == f"entropy_mixed:6:{6 + len(MIXED)}"
    assert got[4]["spans"].startswith("assign:0:") and "entropy" not in got[4]["spans"]
    assert all(got[i]["spans"] == "" for i in (1, 2, 3, 5, 6, 7))


def test_path_rule_equals_its_pattern_and_survives_long_paths(spark):
    """The flat path conditions allow exactly what the one-line pattern allows, and a 1 MB path does not overflow."""
    pattern = re.compile(r"^/?(?:[A-Za-z0-9]{1,14}[/_-]){2,}[A-Za-z0-9]{0,14}$")
    rnd = random.Random(4)
    hits = ["ab1/" * 2000, "ab1/" * 250_000, "/a/b", "a/b", "a/b/", "/a/b/c", "//a/b", "a//b/c", "x" * 15 + "/a/b", "-a/b/c", "a_b-c", "a/b/" + "c" * 14]
    hits += ["".join(rnd.choice("ab1/_-") for _ in range(rnd.randint(1, 40))) for _ in range(400)]
    got = spark.createDataFrame([(h,) for h in hits], "hit string").select(secret_scan.path_like(F.col("hit")).alias("p")).collect()
    assert [r["p"] for r in got] == [bool(pattern.match(h)) for h in hits]
    assert scan(spark, ["key ab1/" * 1 + "ab1/" * 250_000]) is not None
