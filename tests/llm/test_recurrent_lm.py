import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folio.llm import recurrent_lm
from folio.llm.recurrent_lm import Gru


@pytest.fixture(scope="module")
def model():
    counts = np.random.default_rng(1).integers(1, 500, recurrent_lm.VOCABULARY).astype(float)
    return Gru.start(counts), counts


def test_probabilities_add_up_to_one(model):
    net, counts = model
    h = np.random.default_rng(2).normal(0, 1, (1, recurrent_lm.HIDDEN)).astype(np.float32)
    total = np.exp(net.log_prob(np.repeat(h, recurrent_lm.VOCABULARY, 0), np.arange(recurrent_lm.VOCABULARY))).sum()
    assert total == pytest.approx(1, abs=1e-4)
    zero = Gru(net.flat.copy())
    for name in ("wc", "wm"):
        zero.p[name][:] = 0
    first = np.exp(zero.log_prob(h, np.array([5])))[0]
    assert first == pytest.approx((counts[5] + 0.1) / (counts + 0.1).sum(), rel=1e-3)


def test_gradient_is_that_of_the_loss(model):
    net = Gru(model[0].flat.astype(np.float64))
    rng = np.random.default_rng(3)
    inputs, targets = rng.integers(0, 40, (4, 3)), rng.integers(0, recurrent_lm.VOCABULARY, (4, 3))
    inputs[2, 1] = 0  # a document ends here
    start = rng.normal(0, 1, (3, recurrent_lm.HIDDEN))

    def loss(flat):
        other, h, states = Gru(flat), start, []
        for tokens in inputs:
            h, _ = other.step(tokens, h)
            states.append(h)
        return -other.log_prob(np.concatenate(states), targets.ravel()).sum()

    _, grad = net.train_window(inputs, targets, start)
    large = np.argsort(-np.abs(grad.flat))[:2000]
    for i in rng.choice(large, 25, replace=False):
        step = np.zeros_like(net.flat)
        step[i] = 1e-5
        numeric = (loss(net.flat + step) - loss(net.flat - step)) / 2e-5
        assert numeric == pytest.approx(grad.flat[i], rel=1e-3, abs=1e-5)


def test_lanes_do_not_change_scores(model):
    net, rng = model[0], np.random.default_rng(4)
    docs = [rng.integers(1, recurrent_lm.VOCABULARY, n).astype(np.int16) for n in [0, 1, 5, 700, 33, 16, *range(300)]]
    together = net.score(docs)
    for d in (0, 1, 3, 5, 200):
        h, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), 0.0
        for before, token in zip([0, *docs[d]], [*docs[d], 0]):
            h, _ = net.step(np.array([before]), h)
            total += net.log_prob(h, np.array([token], np.int64))[0]
        assert together[d] == pytest.approx(total, rel=1e-4)


def test_words_are_those_of_ascii_white_space():
    texts = ["", "  ", " A b\tA\x0bc\x0cd\re\n\n ", "é\x85ü\xa0x \x1c y\u2003z", "Ä B ä b"]
    codes = recurrent_lm.Codes([b"a", b"b"])
    code, counts, distinct, place = codes.coded(pa.array(texts))
    words = [t.encode().lower().split() for t in texts]
    assert [distinct[i] for i in place] == [w for ws in words for w in ws]
    assert counts.tolist() == [len(ws) for ws in words] and code.tolist() == [codes[w] for ws in words for w in ws]


def test_base_is_exact_and_the_model_is_better_on_held_out_text(spark, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "FREQUENT", 60)  # most words take the way of rare ones
    monkeypatch.setattr(recurrent_lm, "GRADIENT_SHARE", 1)
    rng = random.Random(5)
    tongues = [[f"{a}{b}{end}" for a in "kltr" for b in "aeiou" for end in ends] for ends in (("na", "mo"), ("sch", "rt"))]
    rows = [(i, " ".join(rng.choice(tongues[i % 2]) + ("X" if rng.random() < 0.05 else "") for _ in range(rng.randint(0, 120)))) for i in range(400)]
    rows += [(0, rows[0][1]), (900, None)]
    got = recurrent_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    tokens = [(i, [*(text or "").lower().split(), None]) for i, text in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(t for i, ts in tokens if not held(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    by_id = dict(tokens)
    assert len(got) == len(rows)
    for r in got.itertuples():
        ts = by_id[r.id]
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ts), sum(counts[t] > 0 for t in ts), n, held(r.id))
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum() + 0.05 * out.n_tokens.sum()


def test_every_training_document_is_read_by_a_round(spark):
    docs = spark.range(2000).withColumnRenamed("id", "key").withColumn("held_out", recurrent_lm.is_held_out(F.col("key")))
    rounds = docs.where("NOT held_out").select(recurrent_lm.gradient_round(F.col("key")).alias("r")).groupBy("r").count().collect()
    read = {r["r"]: r["count"] for r in rounds}
    assert sum(read.get(i, 0) for i in range(recurrent_lm.ROUNDS)) == docs.where("NOT held_out").count()
    assert all(read.get(i, 0) > 0 for i in range(recurrent_lm.ROUNDS))


def test_sums_of_runs_of_rows():
    rng = np.random.default_rng(6)
    sizes = np.array([1, 2, 7, 1, 64, 5, 33, 1])
    rows = rng.integers(-50, 50, (sizes.sum(), 3)).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    kept = rows.copy()
    assert np.array_equal(recurrent_lm._run_sums(rows, first), np.add.reduceat(rows, first))
    assert np.array_equal(rows, kept)


def test_largest_scores_do_not_overflow():
    scores = np.array([[900.0, 1, 2, 3], [-900, -900, -900, -1000]], np.float32)
    powers, log_of, sums = recurrent_lm._softmax(scores, np.array([0, 3]))
    assert log_of == pytest.approx([0, -100 - math.log(3)]) and sums == pytest.approx([1, 3])
    assert np.isfinite(powers).all()


def test_training_is_a_step_per_window_of_the_whole_gradient(model):
    """Against the same steps on all weights at once; tokens that no window reads keep their rows."""
    stream = np.random.default_rng(8).integers(0, 60, 900).astype(np.int16)
    trained, plain = Gru(model[0].flat.copy()), Gru(model[0].flat.copy())
    squares, plain_squares = (np.full(len(plain.flat), 1e-6, np.float32) for _ in range(2))
    trained.train(stream, squares)
    lanes = min(recurrent_lm.LANES, len(stream) // (2 * recurrent_lm.WINDOW))
    lane = stream[: len(stream) // lanes * lanes].reshape(lanes, -1).T
    h = np.zeros((lanes, recurrent_lm.HIDDEN), np.float32)
    for start in range(0, len(lane) - 1, recurrent_lm.WINDOW):
        targets = lane[start + 1 : start + 1 + recurrent_lm.WINDOW]
        h, grad = plain.train_window(lane[start : start + len(targets)], targets, h)
        g = grad.flat / targets.size
        g *= min(1.0, 5.0 / np.linalg.norm(g))
        plain_squares += g * g
        plain.flat -= recurrent_lm.RATE * g / np.sqrt(plain_squares)
    assert np.abs(trained.flat - plain.flat).max() < 1e-4 and np.abs(trained.flat - model[0].flat).max() > 0.01
    assert squares == pytest.approx(plain_squares, rel=1e-3)
    assert np.array_equal(trained.p["x"][60:], model[0].p["x"][60:])


def test_texts_are_coded_once(spark, tmp_path):
    """Training and scoring read the staged tokens, not the texts again."""
    rows = [(i, f"one Two three{i % 7} " * (i % 9)) for i in range(60)] + [(60, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "texts"))
    got = recurrent_lm.score(spark.read.parquet(str(tmp_path / "texts")))
    assert not [f for f in got.inputFiles() if str(tmp_path) in f]
    assert {r["id"]: r["n_tokens"] for r in got.collect()} == {i: len((text or "").split()) + 1 for i, text in rows}


def test_tokens_of_a_part_of_a_staged_column():
    documents = [np.array(d, np.int16) for d in ([0], [3, 1, 0], [2, 2, 2, 0], [1, 0])]
    column = pa.array([d.tobytes() for d in documents], pa.binary())
    place = np.array([0, 7, 8, 9], np.int16)
    for start, stop in ((0, 4), (1, 3), (3, 4)):
        tokens, cuts = recurrent_lm._tokens(column[start:stop], place)
        assert [tokens[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [place[d].tolist() for d in documents[start:stop]]


def test_codes_of_rare_words_are_those_of_their_buckets():
    words = [b"", b"a", b"ab", b"abc", b"xabc", b"\xc3\xa9t\xc3\xa9", b"f", b"x" * 200]
    codes = recurrent_lm.Codes([b"a", b"f"])
    rare = lambda w: 3 + recurrent_lm.bucket(w)
    assert codes.of(pa.array(words, pa.binary())).tolist() == [{b"a": 1, b"f": 2}.get(w) or rare(w) for w in words]


def test_scores_of_a_usual_size_give_the_same_as_shifted_ones():
    rng = np.random.default_rng(9)
    scores, target = rng.normal(0, 10, (200, 32)), rng.integers(0, 32, 200)
    powers, log_of, sums = recurrent_lm._softmax(scores.copy(), target)
    assert log_of == pytest.approx(scores[np.arange(200), target] - np.log(np.exp(scores).sum(1)))
    scores[0, 0] = 400
    _, shifted, _ = recurrent_lm._softmax(scores.copy(), target)
    assert shifted[1:] == pytest.approx(log_of[1:])


def test_windows_sorted_together_do_not_change_training(model, monkeypatch):
    stream = np.random.default_rng(10).integers(0, 90, 5000).astype(np.int16)
    flats = []
    for windows in (64, 1):
        monkeypatch.setattr(recurrent_lm, "SORTED_WINDOWS", windows)
        net = Gru(model[0].flat.copy())
        net.train(stream, np.full(len(net.flat), 1e-6, np.float32))
        flats.append(net.flat)
    assert np.array_equal(*flats)
