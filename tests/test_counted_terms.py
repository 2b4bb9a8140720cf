"""Bags counted by batches, and the machines of all folds fitted together."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folio.functions.arrays import _count, _join, count_ngrams
from folio.models import hinge
from folio.operators import terms


def grams(words, lo, hi):
    return [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 2), (2, 3)])
def test_counts_equal_the_counted_strings(lo, hi):
    rng = random.Random(1)
    rows = [None, [], ["a b", "a", "b"]]
    rows += [[rng.choice(["a", "b", "é", "zz", "a b"]) for _ in range(rng.randint(0, 12))] for _ in range(50)]
    column = pa.array(rows, pa.list_(pa.string()))
    want = [sorted(Counter(grams(r or [], lo, hi)).items(), key=lambda x: x[0].encode()) for r in rows]
    got = [[(x["term"], x["n"]) for x in r or []] for r in _count(column, lo, hi).to_pylist()]
    assert got == want
    assert _join(column, lo, hi).to_pylist() == [None if r is None else grams(r, lo, hi) for r in rows]


def test_tallies_and_chi2_of_all_folds(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "x", "y", "z"]), i % 3, [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, label string, fold int, t array<string>")
    bags = df.select("id", "label", "fold", count_ngrams(F.col("t")).alias("bag"))
    found = {(r["term"], r["label"]): (r["df"], r["total"]) for r in terms.bag_tallies(bags, ("label",)).collect()}
    df_of, total_of = Counter(), Counter()
    for _, label, _, t in rows:
        df_of.update((w, label) for w in set(t))
        total_of.update((w, label) for w in t)
    assert found == {key: (df_of[key], total_of[key]) for key in df_of}
    best = terms.fold_chi2_best(terms.bag_tallies(bags, ("label", "fold")), df.select("label", "fold"), 3, 4)
    postings = bags.select("id", "label", "fold", F.inline("bag"))
    for f, got in enumerate(best):
        alone = terms.select_k_best(postings.filter(F.col("fold") != f), df.filter(F.col("fold") != f), 4)
        assert got == sorted(r["term"] for r in alone.collect())


def test_machines_fitted_together_reach_the_optimum_of_each(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(1.0, (120, 4))
    y = (x[:, 0] + rng.normal(0, 0.7, 120) > x[:, 1]).astype(int)
    rows = [(i, str(y[i]), int(y[i]), i % 2, list(range(4)), [int(v) for v in x[i]]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, label string, label_idx int, fold int, g array<int>, n array<long>")
    fitted = hinge.fit(df, [[0, 1, 2], [0, 1, 3]], 4, 1.0)

    def objective(f, k, w, b):
        train = np.arange(120) % 2 != f
        sign = np.where(y == k, 1.0, -1.0)[train]
        return np.maximum(0, 1 - sign * (x[train] @ w + b)).mean() + (w @ w) / (2 * train.sum())

    for f in range(2):
        assert fitted[f][0][0][3 - f] == 0.0  # a column the fold does not use
        for k in range(2):
            w, b = fitted[f][k]
            least = objective(f, k, w, b)
            for _ in range(300):
                step = rng.normal(0, 0.05, 5)
                step[3 - f] = 0.0
                assert objective(f, k, w + step[:4], b + step[4]) > least * 0.98
    scored = {r["id"]: r for r in hinge.predict(df, fitted, 4).collect()}
    for i in range(120):
        s = np.array([x[i] @ w + b for w, b in fitted[i % 2]])
        assert scored[i]["p"] == s.argmax() and scored[i]["decided"] == list((s > 0).astype(int))
