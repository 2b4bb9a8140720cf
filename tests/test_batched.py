"""The batched solver against dense fits in numpy, set by set, and against itself on one set at a time."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.models import batched as B

K = 3
WORDS = [f"w{i}" for i in range(40)]
LEARNERS = [
    B.Learner("tfidf_lr", "logistic", "tfidf", c=5.0),
    B.Learner("svc", "squared_hinge", "tfidf", c=1.0),
    B.Learner("bow_nb", "naive_bayes", "counts", max_n=1),
]


def corpus(seed=0, n=90):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = i % K
        words = [rnd.choice(WORDS[label * 10 : label * 10 + 14] if rnd.random() < 0.6 else WORDS) for _ in range(rnd.randint(0, 25))]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        rows.append((i, label, terms))
    return rows


def sets_of(i, k=3):
    return [f for f in range(k) if f != i % k], [i % k]


def matrix(spark, rows, **cut):
    data = [(i, y, *sets_of(i), t) for i, y, t in rows]
    df = spark.createDataFrame(data, "id long, label_idx int, sets array<int>, scored array<int>, terms array<string>")
    return B.build_matrix(df, LEARNERS, K, **cut)


def dense(rows, set_id, max_n, min_df, max_df, max_features):
    """Vocabulary, counts and TF-IDF of one training set, by the definition."""
    train = [(i, y, [t for t in terms if max_n > 1 or " " not in t]) for i, y, terms in rows if set_id in sets_of(i)[0]]
    n = len(train)
    df, total = Counter(), Counter()
    for _, _, terms in train:
        df.update(set(terms))
        total.update(terms)
    kept = [t for t in df if min_df <= df[t] <= max_df * n]
    kept = sorted(sorted(kept), key=lambda t: -total[t])[:max_features]
    vocab = {t: j for j, t in enumerate(sorted(kept))}
    idf = np.array([math.log((1 + n) / (1 + df[t])) + 1 for t in sorted(kept)])

    def features(terms, weighting):
        x = np.zeros(len(vocab))
        for t, c in Counter(terms).items():
            if t in vocab:
                x[vocab[t]] = c if weighting == "counts" else (1 + math.log(c)) * idf[vocab[t]]
        if weighting == "tfidf" and x.any():
            x /= np.linalg.norm(x)
        return x

    return train, features


def dense_fit(learner, X, y, tol=1e-10):
    n, d = X.shape
    solver = B.lbfgs(np.zeros(d * K + K), tol, 5000)
    x = next(solver)
    while True:
        w, b = x[: d * K].reshape(d, K), x[d * K :]
        s = X @ w + b
        if learner.loss == "logistic":
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            loss = -np.log(p[np.arange(n), y]).sum()
            dz = p.copy()
            dz[np.arange(n), y] -= 1
            reg = np.concatenate([w.ravel(), np.zeros(K)])
        else:
            sign = -np.ones((n, K))
            sign[np.arange(n), y] = 1
            gap = np.maximum(0, 1 - sign * s)
            loss, dz = (gap**2).sum(), -2 * sign * gap
            reg = x.copy()
        g = np.concatenate([(X.T @ dz).ravel(), dz.sum(0)]) / n + reg / (learner.c * n)
        f = loss / n + reg @ reg / (2 * learner.c * n)
        try:
            x = solver.send((f, g))
        except StopIteration as done:
            return done.value, f


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    m = matrix(spark, rows, min_df=2, max_df=0.9, max_features=60)
    return rows, B.fit(m, LEARNERS, tol=1e-7)


def test_vocabularies_follow_the_definition(spark, fitted):
    rows, fit = fitted
    for space, (set_id, max_n) in enumerate(fit.matrix.spaces):
        train, _ = dense(rows, set_id, max_n, 2, 0.9, 60)
        df = Counter(t for _, _, terms in train for t in set(terms) if max_n > 1 or " " not in t)
        assert fit.matrix.width[space] == min(60, sum(1 for t in df if 2 <= df[t] <= 0.9 * len(train)))


@pytest.mark.parametrize("li", [0, 1])
def test_linear_models_equal_dense_fits(spark, fitted, li):
    rows, fit = fitted
    learner = LEARNERS[li]
    for set_id in range(3):
        train, features = dense(rows, set_id, 2, 2, 0.9, 60)
        X = np.array([features(t, learner.weighting) for _, _, t in train])
        y = np.array([label for _, label, _ in train])
        expected, f_best = dense_fit(learner, X, y)
        got = fit.params[(set_id, li)]
        d = X.shape[1]
        w, b = got[: d * K].reshape(d, K), got[d * K :]
        s = X @ w + b
        reg = got.copy() if learner.loss == "squared_hinge" else np.concatenate([w.ravel(), np.zeros(K)])
        if learner.loss == "logistic":
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            loss = -np.log(p[np.arange(len(y)), y]).sum()
        else:
            sign = -np.ones((len(y), K))
            sign[np.arange(len(y)), y] = 1
            loss = (np.maximum(0, 1 - sign * s) ** 2).sum()
        f_got = loss / len(y) + reg @ reg / (2 * learner.c * len(y))
        assert f_got <= f_best + 1e-6
        if learner.loss == "logistic":
            # intercepts are not penalised, so only the probabilities are unique
            e = X @ expected[: d * K].reshape(d, K) + expected[d * K :]
            q = np.exp(e - e.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            assert np.allclose(p, q, atol=1e-4)
        else:
            assert np.allclose(got, expected, atol=1e-3)


def test_naive_bayes_counts(spark, fitted):
    rows, fit = fitted
    train, features = dense(rows, 0, 1, 2, 0.9, 60)
    X = np.array([features(t, "counts") for _, _, t in train])
    y = np.array([label for _, label, _ in train])
    d = X.shape[1]
    counts = np.stack([X[y == c].sum(0) for c in range(K)], 1)
    expected = np.log((counts + 0.1) / (counts.sum(0) + 0.1 * d))
    assert np.allclose(fit.params[(0, 2)][: d * K].reshape(d, K), expected)


def test_together_equals_alone(spark, fitted):
    rows, fit = fitted
    alone = [(i, y, t) for i, y, t in rows]
    data = [(i, y, [1] if 1 in sets_of(i)[0] else [], sets_of(i)[1], t) for i, y, t in alone]
    df = spark.createDataFrame(data, "id long, label_idx int, sets array<int>, scored array<int>, terms array<string>")
    one = B.fit(B.build_matrix(df, LEARNERS[:1], K, min_df=2, max_df=0.9, max_features=60), LEARNERS[:1], tol=1e-7)
    assert np.allclose(one.params[(1, 0)], fit.params[(1, 0)], atol=1e-6)
    scores = {r["id"]: r["scores"] for r in B.predict(one).where(F.col("set") == 1).collect()}
    together = {r["id"]: r["scores"] for r in B.predict(fit).where((F.col("set") == 1) & (F.col("learner") == 0)).collect()}
    assert scores.keys() == together.keys() and all(np.allclose(scores[i], together[i], atol=1e-4) for i in scores)


def test_every_row_is_scored_by_its_held_out_sets(spark, fitted):
    rows, fit = fitted
    got = B.predict(fit).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got} == {i: len(LEARNERS) for i, _, _ in rows}


def test_a_pass_keeps_entries_once_and_sends_one_vector_per_model(spark):
    rows = corpus(1, 200)
    m = matrix(spark, rows, min_df=2, max_df=0.9, max_features=60)
    entries = sum(len(r["g"]) for r in m.rows.select("g").collect())
    pieces = m.pieces().collect()
    assert m.pieces().getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sum(len(np.frombuffer(p[3], np.int32)) for p in pieces) == entries  # not once per set
    jobs = [(s, s, m.spaces.index((s, 2)), 0, np.zeros(int(m.width[m.spaces.index((s, 2))]) * K + K)) for s in range(3)]
    sums = B._evaluate(m, LEARNERS, jobs)
    n = [sum(s in sets_of(i)[0] for i, _, _ in rows) for s in range(3)]
    assert [sums[s][0] for s in range(3)] == pytest.approx([c * math.log(K) for c in n])
    m.release()
