import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folio.llm import mixing


def water_fill(words, weights):
    cap = [3.0 * w for w in words]
    got = [None] * len(words)
    rest = float(sum(words))
    while True:
        open_ = [i for i, g in enumerate(got) if g is None]
        if not open_:
            return got
        level = rest / sum(weights[i] for i in open_)
        above = [i for i in open_ if level * weights[i] >= cap[i]]
        if not above:
            return [level * weights[i] if g is None else g for i, g in enumerate(got)]
        for i in above:
            got[i] = cap[i]
            rest -= cap[i]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    # one source with a third of all rows, a tiny one, and the null source; many rows of one size
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", None])
        size = 40 if i % 6 == 0 else rng.randint(0, 300)
        rows.append((i, " ".join(["w"] * size), source))
    rows += [(1000 + i, "one two", "tiny") for i in range(3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_taken_words(docs):
    got = mixing.mix(docs).toPandas()
    words = defaultdict(int)
    for r in docs.collect():
        words[r["source"]] += len((r["text"] or "").split())
    order = sorted((s for s in words if s is not None), key=lambda s: s.encode()) + [None]
    wanted = dict(zip(order, water_fill([words[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    assert wanted["tiny"] == 18
    for source, own in got.groupby(got.source.fillna("-null-"), dropna=False):
        key = None if source == "-null-" else source
        assert own.source_size.iloc[0] == words[key]
        assert own.target.iloc[0] == pytest.approx(wanted[key])
        assert own.taken.sum() == pytest.approx(wanted[key], rel=0.01, abs=3)
    assert (got.taken == got.copies * got["size"]).all() and (got.copies <= 3).all()


def test_rates_are_tilted_by_size(docs):
    got = mixing.mix(docs).toPandas()
    for _, own in got[(got["size"] > 0) & (got.source != "tiny")].groupby("source"):
        grows = own.target.iloc[0] > own.source_size.iloc[0]
        short, long = own[own["size"] < 80].copies.mean(), own[own["size"] > 220].copies.mean()
        assert (long > short) == grows


def test_reruns_agree(docs):
    first = {(r["id"], r["copies"]) for r in mixing.mix(docs).collect()}
    again = {(r["id"], r["copies"]) for r in mixing.mix(docs.repartition(5, "text")).collect()}
    assert first == again


def test_rows_are_repeated_as_often_as_taken(docs):
    counts = {r["id"]: r["copies"] for r in mixing.mix(docs).collect()}
    repeated = Counter(r["doc_id"] for r in mixing.repeat_rows(docs.withColumn("extra", F.lit(1))).collect())
    assert repeated == {i: n for i, n in counts.items() if n}
