import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from folio.evaluation.validation import cross_predict, cross_validate, temporal_validation
from folio.functions.arrays import count_items, ngrams, normalize_vector
from folio.functions.prompts import parse_category
from folio.models import ensembles, linear
from folio.models.naive_bayes import naive_bayes_cross_predict, naive_bayes_fit, naive_bayes_predict, softmax
from folio.models.vectorize import TextVectorizer
from folio.operators import encode, terms, vectors
from folio.operators.splits import stratified_kfold
from folio.operators.stemming import stem_postings
from folio.sources import artifacts

WORDS = {"mar": "sol playa ola arena barco pez viento costa", "sierra": "monte nieve pino roca viento lobo cumbre sol"}


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        label = ["mar", "sierra"][i % 2]
        words = WORDS[label].split()
        rows.append((i, label, " ".join(rng.choice(words, size=rng.integers(3, 9)))))
    return rows + [(60, "mar", ""), (61, "sierra", "desconocida")]


@pytest.fixture(scope="module")
def texts(spark, corpus):
    return spark.createDataFrame(corpus, "id long, label string, text string").repartition(4).cache()


@pytest.fixture(scope="module")
def postings(texts):
    return terms.term_counts(texts, F.split("text", " "), ("id", "label")).filter("term <> ''")


def test_counts_and_ngrams(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,), (["x"],)], "t array<string>")
    counted = [r[0] for r in df.select(count_items(F.col("t"))).collect()]
    assert counted[0] == [("a", 1), ("b", 2)] and counted[3] == [("x", 1)]
    grams = [r[0] for r in df.select(ngrams(F.col("t"), 1, 2)).collect()]
    assert grams[0] == ["b", "a", "b", "b a", "a b"] and grams[1] == [] and grams[3] == ["x"]
    assert [r[0] for r in df.select(ngrams(F.col("t"), 3, 3)).collect()][:2] == [["b a b"], []]


def brute_tfidf(docs, min_df=3, max_df=0.9):
    df = Counter(t for words in docs.values() for t in set(words))
    kept = {t: d for t, d in df.items() if min_df <= d <= max_df * len(docs)}
    out = {}
    for i, words in docs.items():
        w = {t: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + kept[t])) + 1) for t, n in Counter(words).items() if t in kept}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()})
    return out


def test_tfidf_matches_brute_force(texts, postings, corpus):
    want = brute_tfidf({i: text.split() for i, _, text in corpus})
    bags = terms.term_bags(texts, F.split("text", " "))
    for limits in ({}, {"max_features": None}):  # in the document's row, and by a shuffle of postings
        got = {(r.id, r.term): r.tfidf for r in terms.tfidf(bags, terms.count_rows(texts), **limits).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("cap", [1, 2, 3, 4, 5, 6, 100])
def test_vocabulary_cut_falls_like_a_sort(spark, cap):
    rows = [("b", 3, 5), ("a", 3, 5), ("c", 3, 9), ("e", 3, 2), ("d", 3, 5)]
    stats = spark.createDataFrame(rows, "term string, df long, total long")
    want = [t for t, _, n in sorted(rows, key=lambda r: (-r[2], r[0]))][:cap]
    assert sorted(r.term for r in terms.top_vocabulary(stats, cap).collect()) == sorted(want)


def test_fitted_vectorizer_agrees_with_the_aggregates(spark, texts, corpus, tmp_path):
    want = brute_tfidf({i: text.split() for i, _, text in corpus})
    model = TextVectorizer(tfidf=True).fit(texts)
    path = str(tmp_path / "vectorizer")
    model.write().overwrite().save(path)
    model = PipelineModel.load(path)
    names = model.stages[1].vocabulary
    rows = model.transform(texts).select("id", vector_to_array("features").alias("v")).collect()
    got = {(r.id, names[i]): x for r in rows for i, x in enumerate(r.v) if x}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_vocabulary_cap_and_single_document(spark, texts, postings):
    top = terms.fit_vocabulary(postings, terms.count_rows(texts), max_features=2).collect()
    counts = Counter(dict((r.term, r.total) for r in terms.document_frequency(postings).collect()))
    assert {r.term for r in top} <= {t for t, n in counts.items() if n >= sorted(counts.values())[-4]}
    assert len(top) == 2
    one = spark.createDataFrame([(1, ["a", "a"])], "id long, t array<string>")
    rows = terms.tfidf(terms.term_bags(one, F.col("t")), terms.count_rows(one), min_df=1, max_df=1.0).collect()
    assert [(r.term, r.tfidf) for r in rows] == [("a", 1.0)]


def test_chi2_matches_the_dense_formula(texts, postings, corpus):
    labels = [label for _, label, _ in corpus]
    counts = {label: Counter() for label in set(labels)}
    for _, label, text in corpus:
        counts[label].update(text.split())
    got = {r.term: r.score for r in terms.chi2_scores(postings, texts.select("id", "label")).collect()}
    for term in set().union(*counts.values()):
        total = sum(c[term] for c in counts.values())
        score = 0.0
        for label, c in counts.items():
            exp = total * labels.count(label) / len(labels)
            score += (c[term] - exp) ** 2 / exp
        assert got[term] == pytest.approx(score)


def brute_nb(train, test, alpha=0.1, min_df=3, max_df=0.9):
    df = Counter(t for _, _, text in train for t in set(text.split()))
    vocab = {t for t, d in df.items() if min_df <= d <= max_df * len(train)}
    classes = sorted({label for _, label, _ in train})
    out = {}
    for i, _, text in test:
        scores = []
        for c in classes:
            counts = Counter(t for _, label, x in train if label == c for t in x.split() if t in vocab)
            total = sum(counts.values()) + alpha * len(vocab)
            prior = math.log(sum(label == c for _, label, _ in train) / len(train))
            scores.append(prior + sum(math.log((counts[t] + alpha) / total) for t in text.split() if t in vocab))
        out[i] = scores
    return classes, out


def test_naive_bayes_matches_brute_force(texts, postings, corpus):
    classes, want = brute_nb(corpus, corpus)
    model = naive_bayes_fit(postings, texts, classes)
    rows = naive_bayes_predict(model, postings, texts.select("id", "label")).withColumn("prob", softmax(F.col("scores"))).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r.scores == pytest.approx(want[r.id])
        assert sum(r.prob) == pytest.approx(1.0)
        assert r.p == classes[int(np.argmax(want[r.id]))]


def test_one_pass_folds_match_separate_fits(texts, postings, corpus):
    folds = stratified_kfold(texts.select("id", "label"), 3).select("id", "label", "fold").cache()
    fold_of = {r.id: r.fold for r in folds.collect()}
    rows = naive_bayes_cross_predict(postings.join(folds.select("id", "fold"), "id"), folds, ["mar", "sierra"], 3).collect()
    assert {r.id for r in rows} == set(fold_of)
    for f in range(3):
        train = [row for row in corpus if fold_of[row[0]] != f]
        test = [row for row in corpus if fold_of[row[0]] == f]
        _, want = brute_nb(train, test)
        for r in (r for r in rows if r.fold == f):
            assert r.scores == pytest.approx(want[r.id])


@pytest.mark.parametrize("spec", linear.SPECS.values(), ids=list(linear.SPECS))
def test_linear_models_beat_the_majority(texts, spec):
    model = linear.fit_text_model(spec, texts)
    rows = model.predict(texts).collect()
    assert len(rows) == 62
    assert sum(r.label == r.p for r in rows) > 55
    weights = linear.coefficient_weights(texts.sparkSession, model)
    top = {(r.label, r.term) for r in terms.top_features_per_class(weights, 4).collect()}
    assert len(top) == 8
    assert not {t for c, t in top if c == "mar"} & {"monte", "nieve", "lobo"}


def test_model_round_trip(spark, texts, tmp_path):
    model = linear.fit_text_model(linear.TFIDF_LR, texts)
    path = str(tmp_path / "m")
    artifacts.save_model(model.pipeline, encode.label_index_sorted(texts), path)
    pipeline, index = artifacts.load_model(spark, path)
    again = linear.FittedModel("m", model.classes, pipeline)
    key = ["id", "p"]
    assert sorted(again.predict(texts).select(key).collect()) == sorted(model.predict(texts).select(key).collect())
    assert {r.label: r.label_idx for r in index.collect()} == {"mar": 0, "sierra": 1}


def test_ensembles(texts):
    vote = ensembles.fit_voting(texts, ["mar", "sierra"]).predict(texts).collect()
    assert len(vote) == 62 and all(sum(r.scores) == pytest.approx(1.0) for r in vote)
    stacked = {r.id: r.p for r in ensembles.fit_stacking(texts, ["mar", "sierra"]).predict(texts).collect()}
    truth = {r.id: r.label for r in texts.collect()}
    assert stacked.keys() == truth.keys()
    assert sum(stacked[i] == truth[i] for i in truth) > 55


def test_a_class_without_training_rows_gets_no_share(spark, texts):
    classes = ["mar", "sierra", "valle"]
    vote = ensembles.fit_voting(texts, classes).predict(texts).collect()
    assert all(len(r.scores) == 3 and r.scores[2] < 1e-6 for r in vote)
    rare = texts.unionByName(spark.createDataFrame([(999, "valle", "sol luna mar")], "id long, label string, text string").select(texts.columns))
    stacked = ensembles.fit_stacking(rare, classes).predict(rare).collect()
    assert len(stacked) == 63 and all(r.p in classes for r in stacked)


def test_voting_ties_take_the_first_class(spark):
    df = spark.createDataFrame([("a", 1, [0.7, 0.3]), ("b", 1, [0.3, 0.7])], "model string, id int, scores array<double>")
    assert ensembles.soft_voting(df, ["x", "y"]).first().p == "x"


def test_validation_runs(spark, texts):
    def fit_predict(train, test):
        return linear.fit_text_model(linear.TFIDF_SVC, train).predict(test)

    out = cross_validate(lambda: cross_predict(texts, fit_predict, 2), "tfidf_svc").first()
    assert out.accuracy_mean > 0.8 and out.train_time_s > 0
    dated = texts.withColumn("date", F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int") * 3))
    rows = temporal_validation(dated, fit_predict, model="tfidf_svc").collect()
    assert rows[0].train_size + rows[0].test_size == 62
    with pytest.raises(ValueError):
        temporal_validation(dated.filter("id < 4"), fit_predict, model="m")


def test_word_averages(spark):
    docs = spark.createDataFrame([(1, "sol sol luna x"), (2, "x"), (3, "")], "id long, text string")
    rows = terms.term_counts(docs, F.split("text", " "), ("id",))
    words = spark.createDataFrame([("sol", [1.0, 0.0]), ("luna", [0.0, 3.0])], "word string, vec array<double>")
    got = {r.id: r.vec for r in vectors.mean_word_vector(docs, rows, words, 2).collect()}
    assert got == {1: pytest.approx([2 / 3, 1.0]), 2: [0.0, 0.0], 3: [0.0, 0.0]}
    chars = {r.id: r.vec for r in vectors.mean_word_vector(docs, rows, words, 2, denominator="chars").collect()}
    assert chars[1] == pytest.approx([2 / 14, 3 / 14]) and chars[3] == [0.0, 0.0]


def test_normalize_keeps_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(normalize_vector(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_layer_pooling_order(spark):
    rows = [(0, p, layer, [float(layer), float(p)]) for p in range(2) for layer in range(13)]
    df = spark.createDataFrame(rows, "doc long, pos int, layer int, vec array<float>")
    joined = {r.pos: r.vec for r in vectors.concat_layers(df).collect()}
    assert joined[1] == [12.0, 1.0, 11.0, 1.0, 10.0, 1.0, 9.0, 1.0]
    assert {r.pos: r.vec for r in vectors.sum_layers(df).collect()}[1] == [42.0, 4.0]
    assert vectors.pool_tokens(df).first().vec == [11.0, 0.5]


def test_fixed_length_encoding(spark):
    vocabulary = spark.createDataFrame([("a", 4), ("b", 5)], "term string, token_id int")
    df = spark.createDataFrame([(1, ["b", "z", "a", "a", "a", "b"]), (2, []), (3, ["a"])], "id long, t array<string>")
    got = {r.id: r for r in encode.encode_fixed_length(df, F.col("t"), vocabulary, 6).collect()}
    assert got[1].input_ids == [2, 5, 1, 4, 4, 3] and got[1].attention_mask == [1] * 6
    assert got[2].input_ids == [2, 3, 0, 0, 0, 0] and got[2].attention_mask == [1, 1, 0, 0, 0, 0]
    assert got[3].input_ids == [2, 4, 3, 0, 0, 0] and got[3].token_type_ids == [0] * 6


def test_label_indices(spark):
    df = spark.createDataFrame([(1, "z"), (2, "a"), (3, "z")], "id int, label string")
    assert {r.label: r.label_idx for r in encode.label_index_first_seen(df, "id").collect()} == {"z": 0, "a": 1}
    assert {r.label: r.label_idx for r in encode.label_index_sorted(df).collect()} == {"a": 0, "z": 1}
    assert encode.class_list(df) == ["a", "z"]


def test_embedding_batches_have_unit_norm(spark):
    df = spark.createDataFrame([(i, f"texto {i}") for i in range(130)], "id long, text string")
    rows = vectors.embed_batch(df, "text", vectors.hashing_encoder(8)).collect()
    norms = [np.linalg.norm(r.embedding) for r in rows]
    # opposite hashes of the two tokens may cancel to a zero vector
    assert len(rows) == 130 and all(n == pytest.approx(1.0) or n == 0.0 for n in norms)


def test_stemmed_postings_add_up(spark):
    df = spark.createDataFrame([(1, "torneo", 2), (1, "torneos", 1), (2, "sol", 1)], "id int, term string, n long")
    assert sorted(tuple(r) for r in stem_postings(df).select("id", "term", "n").collect()) == [(1, "torne", 3), (2, "sol", 1)]


def test_cached_artifacts(spark, tmp_path):
    path = str(tmp_path / "cache")
    first = artifacts.materialise_once(spark, path, lambda: spark.range(3))
    again = artifacts.materialise_once(spark, path, lambda: pytest.fail("computed twice"))
    assert first.count() == again.count() == 3
    assert artifacts.read_metrics(spark, str(tmp_path / "none")).count() == 0


def test_parsed_categories(spark):
    values = ["(Economía) porque", " politica", "(otra)", "", None]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = [r[0] for r in df.select(parse_category(F.col("a"), ["politica", "economía"])).collect()]
    assert got == ["economía", "politica", None, None, None]
