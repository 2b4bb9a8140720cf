"""The manifest against a direct computation in Python, and its defined cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm import merkle
from folio.llm.queries import op11_tamper

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def runs(nodes):
    return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]


def fold(nodes):
    """Levels of a tree: lists of digests, bottom first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(r)) for r in runs(levels[-1])])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        start = at - at % 8
        run = nodes[start : start + 8]
        out.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return out


def brute(rows, tamper):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda l: (l is not None, (l or "").encode()))
    trees, result = {}, {}
    for lang in order:
        leaves = [(r, H("".join(part(v) for v in (r[0], r[3], r[2], r[4], r[1])))) for r in by_lang[lang]]
        leaves.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = (leaves, fold([d for _, d in leaves]))
    top = fold([trees[l][1][-1][0] for l in order])
    root = top[-1][0]
    out = []
    for j, lang in enumerate(order):
        leaves, levels = trees[lang]
        for i, (r, leaf) in enumerate(leaves):
            chain = siblings(levels, i) + siblings(top, j)
            text = r[1]
            if tamper(r[0]) and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            acc = H("".join(part(v) for v in (r[0], r[3], r[2], r[4], text)))
            for before, after in chain:
                acc = H(before + acc + after)
            proof = H("".join(b + a for b, a in chain))
            out.append((r[0], lang, leaf, levels[-1][0], root, proof, acc, acc == root))
    return sorted(out, key=repr)


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def run(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(docs, op11_tamper(docs))
    cols = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in got.select(*cols).collect()], key=repr)


def test_many_languages_and_levels(spark):
    rnd = random.Random(5)
    langs = [None, "en", "de", "fr", "es", "it", "ñu", "Zz", "a", "b", "c"]
    rows = []
    for i in range(700):
        lang = rnd.choice(langs[:3]) if i < 600 else rnd.choice(langs)
        text = rnd.choice([None, "", "Hello World", "ÀB c " * rnd.randint(1, 5), "x" * rnd.randint(0, 30)])
        rows.append((rnd.choice([i, i, None]) if i % 97 == 0 else i, text, lang, rnd.choice([None, "s1", "é"]), rnd.choice([None, 3, 12345])))
    rows += rows[:20]  # repeated rows
    assert run(spark, rows) == brute(rows, tampered)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_tree_sizes(spark, n):
    rows = [(i, f"Text {i} ABC", "en", "s", i) for i in range(n)]
    got = run(spark, rows)
    assert got == brute(rows, tampered)
    assert all(r[7] == (not tampered(r[0])) for r in got)


def test_single_row_is_its_own_root(spark):
    got = run(spark, [(3, "lower only", None, None, None)])
    assert got[0][2] == got[0][3] == got[0][4] == got[0][6]
    assert got[0][5] == H("")


def test_empty_table(spark):
    assert run(spark, []) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "A", "en", "s", 1, "x", "y")], SCHEMA + ", leaf string, chain string")
    got = merkle.manifest(docs, op11_tamper(docs)).collect()
    assert len(got) == 1 and got[0]["root"] == got[0]["leaf"]
