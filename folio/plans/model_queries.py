"""Classifiers, ensembles, validation runs, prompts and reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import CV_FOLDS, K_BEST, SVC_C
from folio.evaluation.metrics import auc_binary, cv_summary
from folio.evaluation.reports import report_lines
from folio.evaluation.validation import cross_predict, temporal_validation
from folio.functions import prompts
from folio.models import ensembles, hinge, linear
from folio.models.naive_bayes import (
    naive_bayes_cross_predict,
    naive_bayes_fit,
    naive_bayes_predict,
)
from folio.models.vectorize import TextCleaner
from folio.operators import terms
from folio.operators.encode import class_list, label_index_sorted
from folio.operators.splits import stratified_kfold, temporal_split
from folio.operators.terms import term_counts
from folio.plans.inputs import (
    ARTICLES_SQL,
    BIGRAM_POSTINGS_SQL,
    CLASSES,
    POSTINGS_SQL,
    VOCABULARY_SQL,
    articles,
    clean_terms,
    documents,
    folded_postings,
    labels,
    legacy_bags,
    legacy_terms,
    staged_postings,
)
from folio.plans.registry import query
from folio.plans.score_queries import (
    PROBABILITIES_SQL,
    predictions,
    probabilities,
)
from folio.session import scratch_path, stage
from folio.sources import artifacts

_ALPHA = "0.1::DOUBLE"
NB_SQL = f"""{POSTINGS_SQL}, {VOCABULARY_SQL},
cells AS (SELECT label, term, sum(n) AS n FROM postings JOIN vocabulary USING (term) GROUP BY label, term),
totals AS (SELECT label, sum(n) AS total FROM cells GROUP BY label),
size AS (SELECT count(*) AS size FROM vocabulary),
theta AS MATERIALIZED (
  SELECT t.label, v.term, ln((coalesce(c.n, 0) + {_ALPHA}) / (t.total + {_ALPHA} * size)) AS w
  FROM vocabulary v CROSS JOIN totals t CROSS JOIN size
  LEFT JOIN cells c ON c.term = v.term AND c.label = t.label),
priors AS (SELECT lang AS label, ln(count(*)::DOUBLE / (SELECT count(*) FROM documents)) AS prior
  FROM documents GROUP BY lang)"""


def _nb(spark, sf):
    rows = staged_postings(spark, sf)
    return rows, naive_bayes_fit(rows, labels(spark, sf), CLASSES)


@query(
    "naive_bayes_fit",
    f"""WITH {NB_SQL}
SELECT label, term, round(w, 6) AS w FROM theta UNION ALL SELECT label, '', round(prior, 6) FROM priors""",
)
def nb_fit(spark, sf):
    """Log probabilities per class and term; the prior has the empty term."""
    _, model = _nb(spark, sf)
    weights = model.weights.unionByName(model.prior.select(F.lit("").alias("term"), F.col("prior").alias("w")))
    return weights.select("term", F.posexplode("w").alias("i", "x")).select(
        F.get(F.lit(list(CLASSES)), F.col("i")).alias("label"), "term", F.round("x", 6).alias("w")
    )


_NB_SCORES_SQL = """scores AS (
  SELECT d.doc_id AS id, d.lang AS y, p.label, p.prior + coalesce(s.score, 0) AS score
  FROM documents d CROSS JOIN priors p LEFT JOIN (
    SELECT id, theta.label, sum(n * w) AS score FROM postings JOIN theta USING (term) GROUP BY id, theta.label) s
  ON s.id = d.doc_id AND s.label = p.label)"""


@query(
    "naive_bayes_predict",
    f"""WITH {NB_SQL}, {_NB_SCORES_SQL}
SELECT id, y, label AS p, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1""",
)
def nb_predict(spark, sf):
    rows, model = _nb(spark, sf)
    done = naive_bayes_predict(model, rows, labels(spark, sf))
    return done.select("id", F.col("label").alias("y"), "p", F.round(F.array_max("scores"), 4).alias("score"))


NB_CV_SQL = f"""{POSTINGS_SQL},
folds AS MATERIALIZED (
  SELECT doc_id AS id, lang AS label,
         CAST((row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || ':42')) - 1) % 5 AS INTEGER)
         AS fold FROM documents),
runs AS (SELECT unnest(range(5))::INTEGER AS run),
train AS (SELECT run, f.id, f.label FROM runs JOIN folds f ON f.fold <> run),
train_sizes AS (SELECT run, count(*) AS n FROM train GROUP BY run),
train_terms AS (
  SELECT run, p.term, count(*) AS df, sum(p.n) AS total
  FROM postings p JOIN train t ON t.id = p.id GROUP BY run, p.term),
kept AS MATERIALIZED (
  SELECT run, term FROM (
    SELECT run, term, row_number() OVER (PARTITION BY run ORDER BY total DESC, term) AS rn
    FROM train_terms JOIN train_sizes USING (run) WHERE df >= 3 AND df <= 0.9::DOUBLE * n) WHERE rn <= 50000),
cells AS (
  SELECT t.run, t.label, p.term, sum(p.n) AS n FROM postings p JOIN train t ON t.id = p.id
  JOIN kept k ON k.run = t.run AND k.term = p.term GROUP BY t.run, t.label, p.term),
totals AS (SELECT run, label, sum(n) AS total FROM cells GROUP BY run, label),
vsize AS (SELECT run, count(*) AS size FROM kept GROUP BY run),
priors AS (SELECT run, label, ln(count(*)::DOUBLE / n) AS prior FROM train JOIN train_sizes USING (run) GROUP BY run, label, n),
theta AS MATERIALIZED (
  SELECT k.run, t.label, k.term, ln((coalesce(c.n, 0) + {_ALPHA}) / (t.total + {_ALPHA} * s.size)) AS w
  FROM kept k JOIN totals t ON t.run = k.run JOIN vsize s ON s.run = k.run
  LEFT JOIN cells c ON c.run = k.run AND c.term = k.term AND c.label = t.label),
sums AS (
  SELECT p.id, h.label, sum(p.n * h.w) AS score
  FROM postings p JOIN folds f ON f.id = p.id JOIN theta h ON h.run = f.fold AND h.term = p.term GROUP BY p.id, h.label),
scores AS (
  SELECT f.id, f.fold, f.label AS y, r.label, r.prior + coalesce(s.score, 0) AS score
  FROM folds f JOIN priors r ON r.run = f.fold LEFT JOIN sums s ON s.id = f.id AND s.label = r.label),
predictions AS MATERIALIZED (
  SELECT 'bow_nb' AS model, id, fold, y, label AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1)"""


def nb_out_of_fold(spark, sf):
    folds = stage(stratified_kfold(labels(spark, sf)).select("id", "label", "fold"), "cv-folds")
    return naive_bayes_cross_predict(folded_postings(spark, sf, folds), folds, CLASSES, 5)


@query("naive_bayes_cross_predict", f"WITH {NB_CV_SQL} SELECT id, fold, y, p FROM predictions")
def nb_cross_predict(spark, sf):
    return nb_out_of_fold(spark, sf).select("id", "fold", F.col("label").alias("y"), "p")


_CV_SQL = f"""{NB_CV_SQL},
sides AS (
  SELECT fold, y AS class, 1 AS support, 0 AS predicted, (y = p)::INTEGER AS tp FROM predictions
  UNION ALL SELECT fold, p, 0, 1, 0 FROM predictions),
report AS (
  SELECT fold, class, sum(tp) AS tp, sum(support) AS support,
         coalesce(2 * sum(tp) / nullif(sum(support) + sum(predicted), 0), 0) AS f1 FROM sides GROUP BY fold, class),
folded AS (
  SELECT fold, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1
  FROM report GROUP BY fold)"""


@query(
    "cross_validate",
    f"WITH {_CV_SQL} SELECT 'bow_nb' AS model, "
    + ", ".join(
        f"round(avg({m}), 4) AS {m}_mean, round(stddev_pop({m}), 4) AS {m}_std"
        for m in ("accuracy", "macro_f1", "weighted_f1")
    )
    + " FROM folded",
)
def cross_validate_nb(spark, sf):
    scored = nb_out_of_fold(spark, sf).select(F.lit("bow_nb").alias("model"), "fold", F.col("label").alias("y"), "p")
    return cv_summary(scored)


_TEMPORAL_SQL = f"""{ARTICLES_SQL}, {POSTINGS_SQL},
split AS MATERIALIZED (
  SELECT id, category AS label, date > (SELECT max(date) - INTERVAL 3 MONTH FROM articles) AS is_test
  FROM articles WHERE date IS NOT NULL),
train_size AS (SELECT count(*) AS n FROM split WHERE NOT is_test),
train_postings AS MATERIALIZED (SELECT p.* FROM postings p JOIN split s USING (id) WHERE NOT is_test),
vocabulary AS MATERIALIZED (
  SELECT term FROM (SELECT term, count(*) AS df, sum(n) AS total FROM train_postings GROUP BY term), train_size
  WHERE df >= 3 AND df <= 0.9::DOUBLE * n ORDER BY total DESC, term LIMIT 50000),
cells AS (SELECT label, term, sum(n) AS n FROM train_postings JOIN vocabulary USING (term) GROUP BY label, term),
totals AS (SELECT label, sum(n) AS total FROM cells GROUP BY label),
size AS (SELECT count(*) AS size FROM vocabulary),
theta AS MATERIALIZED (
  SELECT t.label, v.term, ln((coalesce(c.n, 0) + {_ALPHA}) / (total + {_ALPHA} * size)) AS w
  FROM vocabulary v CROSS JOIN totals t CROSS JOIN size LEFT JOIN cells c ON c.term = v.term AND c.label = t.label),
priors AS (SELECT label, ln(count(*)::DOUBLE / any_value(train_size.n)) AS prior FROM split, train_size
  WHERE NOT is_test GROUP BY label),
sums AS (
  SELECT p.id, h.label, sum(p.n * h.w) AS score FROM postings p JOIN split s ON s.id = p.id AND s.is_test
  JOIN theta h ON h.term = p.term GROUP BY p.id, h.label),
scores AS (
  SELECT s.id, s.label AS y, r.label, r.prior + coalesce(x.score, 0) AS score
  FROM split s CROSS JOIN priors r LEFT JOIN sums x ON x.id = s.id AND x.label = r.label WHERE s.is_test),
predictions AS MATERIALIZED (
  SELECT id, y, label AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1),
sides AS (
  SELECT y AS class, 1 AS support, 0 AS predicted, (y = p)::INTEGER AS tp FROM predictions
  UNION ALL SELECT p, 0, 1, 0 FROM predictions),
report AS (
  SELECT class, sum(tp) AS tp, sum(support) AS support,
         coalesce(sum(tp) / nullif(sum(predicted), 0), 0) AS "precision",
         coalesce(sum(tp) / nullif(sum(support), 0), 0) AS recall,
         coalesce(2 * sum(tp) / nullif(sum(support) + sum(predicted), 0), 0) AS f1 FROM sides GROUP BY class),
run AS (
  SELECT CAST(sum(support) AS BIGINT) AS test_size, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1,
         sum(f1 * support) / sum(support) AS weighted_f1 FROM report)"""


def nb_fit_predict(train, test):
    """Naive Bayes as a train/test function over ``id, label, text``."""
    model = naive_bayes_fit(
        term_counts(train, clean_terms(), ("id", "label")), train.select("id", "label"), class_list(train)
    )
    scored = naive_bayes_predict(model, term_counts(test, clean_terms(), ("id",)), test.select("id", "label"))
    return scored.select("id", "label", "p")


def labelled_texts(spark, sf):
    """``id, label, text`` of every document."""
    return documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")


def _dated_texts(spark, sf):
    return articles(spark, sf).select("id", F.col("category").alias("label"), F.col("body").alias("text"), "date")


@query(
    "temporal_validation",
    f"""WITH {_TEMPORAL_SQL}
SELECT 'bow_nb' AS model, (SELECT n FROM train_size) AS train_size, test_size, round(accuracy, 4) AS accuracy,
       round(macro_f1, 4) AS macro_f1, round(weighted_f1, 4) AS weighted_f1, class, round("precision", 4) AS "precision",
       round(recall, 4) AS recall, round(f1, 4) AS f1 FROM report, run""",
)
def temporal(spark, sf):
    return temporal_validation(_dated_texts(spark, sf), nb_fit_predict, model="bow_nb")


@query(
    "temporal_linear_validation",
    f"""WITH {_TEMPORAL_SQL}
SELECT model, label AS class, (SELECT n FROM train_size) AS train_size, (SELECT count(*) FROM split WHERE is_test) AS test_size,
       true AS above_majority
FROM (SELECT DISTINCT label FROM split WHERE is_test), (SELECT unnest(['tfidf_lr', 'tfidf_svc']) AS model)""",
)
def temporal_linear(spark, sf):
    """The temporal run of both linear TF-IDF models, and whether each beats the largest class's share of the test rows."""
    rows = linear.with_terms(_dated_texts(spark, sf))
    sizes = temporal_split(rows).filter("split = 'test'").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    share = sizes.agg((F.max("n") / F.sum("n")).alias("share")).scalar()
    parts = []
    for spec in (linear.TFIDF_LR, linear.TFIDF_SVC):
        run = temporal_validation(rows, _spec_predict(spec), model=spec.name)
        above = F.col("accuracy") > share
        parts.append(run.select("model", "class", "train_size", "test_size", above.alias("above_majority")))
    return parts[0].unionByName(parts[1])


_ARGMAX_SQL = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY prob DESC, label) AS rn FROM {1})"""


@query(
    "predict",
    f"""WITH {PROBABILITIES_SQL}, {_ARGMAX_SQL.format('model, id', 'probabilities')}
SELECT model, id, label AS p, round(prob, 6) AS prob FROM ranked WHERE rn = 1""",
)
def predict(spark, sf):
    done = ensembles.predict_class(probabilities(spark, sf), CLASSES)
    return done.select("model", "id", "p", F.round(F.array_max("scores"), 6).alias("prob"))


@query(
    "soft_voting",
    f"""WITH {PROBABILITIES_SQL},
means AS (SELECT id, label, avg(prob) AS prob FROM probabilities GROUP BY id, label),
{_ARGMAX_SQL.format('id', 'means')}
SELECT id, label AS p, round(prob, 6) AS prob FROM ranked WHERE rn = 1""",
)
def soft_voting(spark, sf):
    done = ensembles.soft_voting(probabilities(spark, sf), CLASSES)
    return done.select("id", "p", F.round(F.array_max("scores"), 6).alias("prob"))


def _staged_terms(spark, sf):
    """``id, label, terms`` of every document: cleaned once for all folds and models."""
    return linear.with_terms(labelled_texts(spark, sf))


def _words(spark, sf):
    """``id, label, words`` of every document, cleaned where they are read."""
    return TextCleaner(outputCol="words").transform(labelled_texts(spark, sf)).drop("text")


def _checked(scored):
    """``id, fold, y`` of out-of-fold predictions, and whether they beat the share of the largest class."""
    scored = stage(scored, "out-of-fold")
    total = F.count(F.lit(1))
    accuracy = scored.agg((F.count_if(F.col("y") == F.col("p")) / total).alias("a")).scalar()
    shares = scored.groupBy("y").agg(total.alias("n")).agg((F.max("n") / F.sum("n")).alias("share"))
    return scored.select("id", "fold", "y", (accuracy > shares.scalar()).alias("above_majority"))


def folds_sql(table="documents", key="doc_id", label="lang", more=", true AS above_majority"):
    return f"""SELECT {key} AS id, CAST((row_number() OVER (PARTITION BY {label}
    ORDER BY md5({key}::VARCHAR || ':42')) - 1) % 5 AS INTEGER) AS fold, {label} AS y{more}
FROM {table}"""


def _batched(spark, sf, *learners):
    rows = _words(spark, sf)
    return _checked(ensembles.batched_predictions(rows, class_list(rows), learners))


def _spec_predict(spec):
    return lambda train, test: linear.fit_text_model(spec, train, class_list(train)).predict(test)


@query("logistic_fit", folds_sql())
def logistic(spark, sf):
    """Out-of-fold predictions of TF-IDF logistic regression, all documents and folds, fitted together."""
    return _batched(spark, sf, ensembles.TFIDF_LR_LEARNER)


@query("bow_logistic_fit", folds_sql())
def bow_logistic(spark, sf):
    """Out-of-fold predictions of logistic regression on counts, all folds fitted together."""
    return _batched(spark, sf, ensembles.BOW_LR_LEARNER)


@query("linear_svc_fit", folds_sql())
def linear_svc(spark, sf):
    """Out-of-fold predictions of the one-vs-rest linear SVM (squared hinge) on TF-IDF, all folds fitted together."""
    return _batched(spark, sf, ensembles.TFIDF_SVC_LEARNER)


@query("coefficient_features")
def coefficient_features(spark, sf):
    """The twenty terms of largest coefficient per class of TF-IDF logistic regression on all documents."""
    fitted = linear.fit_text_model(linear.TFIDF_LR, _staged_terms(spark, sf))
    return terms.top_features_per_class(linear.coefficient_weights(spark, fitted))


@query(
    "vectorizer_model",
    f"""WITH {BIGRAM_POSTINGS_SQL}, {VOCABULARY_SQL},
columns AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM vocabulary),
weighted AS (SELECT id, term_idx, (1 + ln(n)) * idf AS w FROM postings JOIN columns USING (term)),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY id)
SELECT id, CAST(term_idx AS INTEGER) AS term_idx, round(w / norm, 6) AS weight FROM weighted JOIN norms USING (id)""",
)
def vectorizer_model(spark, sf):
    """TF-IDF of raw text over one- and two-word terms by a fitted pipeline, entry by entry."""
    texts = stage(labelled_texts(spark, sf).select("id", "text"), "texts")
    fitted = linear.TFIDF_LR.vectorizer().fit(texts)
    # texts stay out of the batches in which vectors are weighed
    done = linear.PipelineModel(fitted.stages[1:]).transform(fitted.stages[0].transform(texts).drop("text"))
    return linear.stored_entries(done).withColumn("weight", F.round("weight", 6))


def _chi2_svc_predictions(spark, sf):
    """Out-of-fold ``fold, id, y, p`` of the older pipeline: its vectoriser, chi-square on the training rows, linear SVM."""
    folds = stage(stratified_kfold(labels(spark, sf)).select("id", "label", "fold"), "folds")
    bags = legacy_bags(spark, sf)
    # counted terms meet the folds only as sums; every fold's features come from one table of them
    cells = terms.bag_tallies(bags.join(folds.select("id", "fold"), "id"), ("label", "fold"))
    cells = cells.join(legacy_terms(bags).select("term"), "term", "left_semi")
    best = terms.fold_chi2_best(cells, folds, CV_FOLDS, K_BEST)
    names = sorted(set().union(*best))
    entries = terms.match_terms(bags.select("id", "bag"), names).filter(F.size("g") > 0)
    # a document that comes twice has the entries of each with each of its rows
    entries = entries.join(folds.select("id"), "id").groupBy("id").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("g", "n")])
    label_idx = linear.label_position(F.col("label"), CLASSES).cast("int").alias("label_idx")
    rows = stage(folds.join(entries, "id", "left").select("id", "label", label_idx, "fold", "g", "n"), "legacy-rows")
    place = {name: i for i, name in enumerate(names)}
    fitted = hinge.fit(rows, [[place[name] for name in kept] for kept in best], len(names), SVC_C)
    scored = hinge.predict(rows, fitted, len(names))
    p = F.get(F.lit(list(CLASSES)), F.col("p")).alias("p")
    return stage(scored.select("fold", "id", F.col("label").alias("y"), p, "decided"), "chi2-predictions")


@query("kernel_svc_linear_fit", folds_sql())
def chi2_svc(spark, sf):
    return _checked(_chi2_svc_predictions(spark, sf))


@query("legacy_fold_scores")
def legacy_fold_scores(spark, sf):
    """Accuracy of every fold of the older pipeline, and the AUC of each class from its machine's own 0/1 decisions."""
    scored = _chi2_svc_predictions(spark, sf)
    accuracy = scored.groupBy("fold").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))
    return auc_binary(scored, CLASSES, ["fold"]).join(accuracy, "fold").select("fold", "class", "accuracy", "auc")


@query("legacy_confusion")
def legacy_confusion(spark, sf):
    """Confusion counts of every fold of the older pipeline."""
    return _chi2_svc_predictions(spark, sf).groupBy("fold", "y", "p").agg(F.count(F.lit(1)).alias("n"))


def _embeddings(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return rows.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), "embedding")


def _embedding_folds_sql():
    # the labels of the embeddings are drawn at random: no classifier beats a majority there
    return folds_sql("embeddings", "vec_id", "label::VARCHAR", "")


@query("one_vs_rest", _embedding_folds_sql())
def one_vs_rest(spark, sf):
    """Out-of-fold predictions of a binary model per class on the embeddings."""

    def fit_predict(train, test):
        classes = tuple(class_list(train))
        ready = linear.dense_features(train, "embedding").withColumn("label_idx", linear.label_position(F.col("label"), classes))
        fitted = linear.one_vs_rest(linear.linear_svc(train.count(), SVC_C)).fit(ready)
        return linear.FittedModel("ovr", classes, fitted).predict(linear.dense_features(test, "embedding"))

    return _checked(cross_predict(_embeddings(spark, sf), fit_predict)).drop("above_majority")


@query("embedding_classifier", _embedding_folds_sql())
def embedding_classifier(spark, sf):
    """Out-of-fold predictions of logistic regression on the embeddings."""

    def fit_predict(train, test):
        return linear.embedding_classifier(train).predict(linear.dense_features(test, "embedding"))

    return _checked(cross_predict(_embeddings(spark, sf), fit_predict)).drop("above_majority")


@query("save_model", _embedding_folds_sql())
def save_model(spark, sf):
    """Each fold's classifier stored with its label index, loaded and applied to the fold."""

    def fit_predict(train, test):
        path = scratch_path(spark, "model")
        fitted = linear.embedding_classifier(train)
        artifacts.save_model(linear.PipelineModel([fitted.pipeline]), label_index_sorted(train), path)
        model, index = artifacts.load_model(spark, path)
        done = model.transform(linear.dense_features(test, "embedding"))
        return done.join(index.withColumnRenamed("label", "p"), F.col("prediction") == F.col("label_idx"))

    return _checked(cross_predict(_embeddings(spark, sf), fit_predict)).drop("above_majority")


@query("voting_fit", folds_sql())
def voting(spark, sf):
    """Out-of-fold predictions of the soft vote of two logistic regressions, both fitted on all folds together."""
    return _batched(spark, sf, ensembles.TFIDF_LR_LEARNER, ensembles.BOW_LR_LEARNER)


@query("stacking", folds_sql())
def stacking(spark, sf):
    """Out-of-fold predictions of the stacked ensemble: every base and meta model of every fold in shared passes."""
    rows = _words(spark, sf)
    return _checked(ensembles.stacking_out_of_fold(rows, class_list(rows)))


_EXAMPLES_SQL = """ranked AS (
  SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
examples AS (
  SELECT string_agg('<EXAMPLE>' || chr(10) || '<INPUT>' || chr(10) || text || chr(10) || '</INPUT>' || chr(10)
         || '<CATEGORY>' || lang || '</CATEGORY>' || chr(10) || '</EXAMPLE>' || chr(10), chr(10) ORDER BY lang, rn) AS examples
  FROM ranked WHERE rn <= 1)"""


@query(
    "few_shot_prompt",
    f"""WITH {_EXAMPLES_SQL}
SELECT doc_id AS id, md5('{prompts.INSTRUCTION}' || chr(10) || chr(10) || examples || chr(10)
  || '{prompts.QUESTION}{", ".join(CLASSES)}.' || chr(10) || '<EXAMPLE>' || chr(10) || '<INPUT>' || chr(10) || text
  || chr(10) || '</INPUT>' || chr(10)) AS prompt_md5
FROM documents, examples""",
)
def few_shot_prompt(spark, sf):
    texts = labelled_texts(spark, sf)
    examples = prompts.few_shot_examples(texts).scalar()
    return texts.select("id", F.md5(prompts.few_shot_prompt(F.col("text"), examples, CLASSES)).alias("prompt_md5"))


@query(
    "chat_messages",
    """WITH systems AS (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id)
SELECT conv_id, turn, '<|im_start|>system' || chr(10) || coalesce(system, 'You are a helpful assistant.') || '<|im_end|>'
  || chr(10) || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt
FROM conversations LEFT JOIN systems USING (conv_id) WHERE role = 'user'""",
)
def chat_messages(spark, sf):
    """Each user turn with its conversation's first system text, rendered for generation."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    systems = (
        turns.filter(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system"))
    )
    rows = turns.filter(F.col("role") == "user").join(systems, "conv_id", "left")
    messages = prompts.chat_messages(F.col("text"), F.col("system"))
    return rows.select("conv_id", "turn", prompts.render_chat(messages).alias("prompt"))


@query(
    "parse_category",
    """SELECT doc_id AS id, CASE WHEN doc_id % 4 < 2 THEN lang END AS category FROM documents""",
)
def parse_category(spark, sf):
    """Answers around the document's language: bare, behind the prompt, unfinished, unknown."""
    kind = F.col("doc_id") % 4
    prompt = F.concat(F.lit("Q: "), F.col("text"), F.lit("\n"))
    answer = (
        F.when(kind == 0, F.concat(F.lit(" ("), F.upper("lang"), F.lit(") because (it) is")))
        .when(kind == 1, F.concat(prompt, F.lit("("), F.col("lang"), F.lit(")")))
        .when(kind == 2, F.concat(F.lit("the category is "), F.col("lang")))
        .otherwise(F.lit("(sport)"))
    )
    parsed = prompts.parse_category(answer, CLASSES, prompt)
    return documents(spark, sf).select(F.col("doc_id").alias("id"), parsed.alias("category"))


@query("report_tables")
def report_tables(spark, sf):
    """The report of the derived articles, predictions and temporal run as ordered lines."""
    from folio.functions.text import clean_tokens

    corpus = articles(spark, sf).select("category", "date", F.size(clean_tokens(F.col("body"))).alias("n_tokens"))
    cv = stage(cv_summary(predictions(spark, sf)), "report-cv")
    temporal_rows = stage(temporal_validation(_dated_texts(spark, sf), nb_fit_predict, model="bow_nb"), "report-temporal")
    return report_lines(stage(corpus, "report-corpus"), cv, temporal_rows)
