"""What the solver and the counters hold at a time, and that it does not change their results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.functions.arrays import native_ngrams, ngrams
from folio.models import batched as B
from folio.models.vectorize import TextVectorizer
from folio.operators.terms import bag_tallies, partial_tallies, term_bags

K = 2
LEARNERS = [B.Learner("bow_lr", "logistic", "counts", c=1.0), B.Learner("svc", "squared_hinge", "tfidf")]


def rows(spark, source):
    rnd, data = random.Random(3), []
    for i in range(60):
        words = [f"w{rnd.randint(0, 9) + 6 * (i % K)}" for _ in range(rnd.randint(0, 15))]
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        data.append((i, i % K, [s for s in range(3) if s != i % 3], [i % 3], words if source == "words" else words + pairs))
    return spark.createDataFrame(data, f"id long, label_idx int, sets array<int>, scored array<int>, {source} array<string>")


def build(spark, source="words"):
    return B.build_matrix(rows(spark, source), LEARNERS, K, min_df=2, max_df=0.9, max_features=40)


def quadratic_passes(scale):
    bend = np.logspace(0, -4, 40)
    solver = B.lbfgs(np.full(40, 1.0), 1e-6, 2000, scale=scale(bend))
    x, n = next(solver), 0
    while True:
        n += 1
        try:
            x = solver.send((0.5 * bend @ (x * x), bend * x))
        except StopIteration as done:
            assert np.max(np.abs(bend * done.value)) <= 1e-6
            return n


def test_scaled_steps_take_fewer_passes():
    assert quadratic_passes(lambda bend: bend**-0.25) < quadratic_passes(lambda bend: 1.0)


def test_words_and_terms_give_the_same_matrix(spark):
    one, other = build(spark), build(spark, "terms")
    assert one.spaces == other.spaces and np.array_equal(one.local, other.local) and np.allclose(one.idf, other.idf)
    entries = [sorted((r["id"], r["g"], r["n"]) for r in m.rows.collect()) for m in (one, other)]
    assert entries[0] == entries[1] and sum(len(g) for _, g, _ in entries[0]) > 0


def test_counts_are_kept_in_a_byte(spark):
    m = build(spark)
    pieces = m.pieces().collect()
    assert {p[5] for p in pieces} == {b"u1"} and all(4 * len(p[4]) == len(p[3]) for p in pieces)
    m.release()


def test_other_values_keep_their_type(spark):
    df = spark.createDataFrame([(i, i % K, [0], [0], [0.5 * i, 300.0]) for i in range(6)], "id long, label_idx int, sets array<int>, scored array<int>, x array<double>")
    m = B.dense_matrix(df, 2, K)
    found = [v for p in m.pieces().collect() for v in np.frombuffer(p[4], p[5].decode())]
    assert sorted(found) == sorted([v for i in range(6) for v in (0.5 * i, 300.0)])
    m.release()


def test_few_solvers_run_at_a_time_with_the_same_results(spark, monkeypatch):
    whole = B.fit(build(spark), LEARNERS, tol=1e-4)
    most, evaluate = [], B._evaluate

    def seen(matrix, learners, jobs):
        most.append(len(jobs))
        return evaluate(matrix, learners, jobs)

    monkeypatch.setattr(B, "_evaluate", seen)
    monkeypatch.setattr(B, "STATE_BYTES", 2 * B._state_bytes(41 * K))
    few = B.fit(build(spark), LEARNERS, tol=1e-4)
    assert max(most) <= 2 and whole.params.keys() == few.params.keys()
    for key, x in whole.params.items():
        assert few.params[key] == pytest.approx(x, abs=1e-4)


def test_a_task_adds_up_a_bounded_number_of_rows(spark):
    df = spark.range(5000).coalesce(1).select(F.array(F.lit("a"), F.lit("b"), F.lit("a")).alias("words"))
    parts = partial_tallies(df, (), (1, 2)).collect()
    assert sorted(r["df"] for r in parts if r["term"] == "a") == [904, 2048, 2048]
    total = {r["term"]: (r["df"], r["total"]) for r in bag_tallies(df, (), (1, 2)).collect()}
    assert total == {"a": (5000, 10000), "b": (5000, 5000), "a b": (5000, 5000), "b a": (5000, 5000)}
    bags = term_bags(df.select(F.lit(1).alias("id"), "words"), F.col("words"), ngram_range=(1, 2))
    assert {r["term"]: (r["df"], r["total"]) for r in bag_tallies(bags).collect()} == total


def test_native_ngrams_equal_those_of_python(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), (["a", "b"],), (["a", "b", "c", "b"],)], "t array<string>")
    for lo, hi in ((1, 1), (1, 2), (2, 2), (1, 3), (2, 3)):
        found = df.select(ngrams(F.col("t"), lo, hi).alias("x"), native_ngrams(F.col("t"), lo, hi).alias("y")).collect()
        assert [r["x"] for r in found] == [r["y"] for r in found]


def test_a_fitted_vectoriser_needs_no_python_for_its_terms(spark):
    df = spark.createDataFrame([(i, "casa perro gato" if i % 2 else "casa mesa silla") for i in range(10)], "id long, text string")
    model = TextVectorizer(maxN=2, tfidf=True, maxDF=1.0).fit(df)
    terms = model.stages[0].transform(df).select("terms")
    assert "joined" not in terms._jdf.queryExecution().executedPlan().toString()  # the UDF of ngrams
    assert {"casa mesa", "perro gato"} <= set(model.stages[1].vocabulary)
