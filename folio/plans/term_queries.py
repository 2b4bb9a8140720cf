"""Term statistics and label encodings."""

from pyspark.sql import functions as F

from folio.config import LEGACY_MAX_DF
from folio.operators import encode, terms
from folio.operators.splits import stratified_kfold
from folio.plans.inputs import (
    BIGRAM_POSTINGS_SQL,
    CLASSES,
    DF_SQL,
    LEGACY_SQL,
    POSTINGS_SQL,
    TFIDF_SQL,
    VOCABULARY_SQL,
    clean_terms,
    documents,
    folded_bags,
    folded_postings,
    labels,
    legacy_bags,
    legacy_terms,
    postings,
    staged_bags,
)
from folio.plans.registry import query
from folio.session import stage


@query("term_counts", f"WITH {POSTINGS_SQL} SELECT id, term, n FROM postings")
def term_counts(spark, sf):
    return postings(spark, sf).select("id", "term", "n")


@query("ngrams", f"WITH {BIGRAM_POSTINGS_SQL} SELECT id, term, n FROM postings")
def ngram_counts(spark, sf):
    return postings(spark, sf, (1, 2)).select("id", "term", "n")


@query(
    "document_frequency",
    f"""WITH {POSTINGS_SQL}, {DF_SQL}
SELECT term, df, total FROM stats, n_docs WHERE df >= 3 AND df <= {LEGACY_MAX_DF}::DOUBLE * n_docs""",
)
def document_frequency(spark, sf):
    stats = terms.document_frequency(postings(spark, sf))
    return terms.prune_by_df(stats, terms.count_rows(labels(spark, sf)), max_df=LEGACY_MAX_DF)


def _vocabulary(spark, sf):
    return terms.fit_vocabulary(postings(spark, sf), terms.count_rows(labels(spark, sf)))


@query("top_vocabulary", f"WITH {POSTINGS_SQL}, {VOCABULARY_SQL} SELECT term, df, total FROM vocabulary")
def top_vocabulary(spark, sf):
    return _vocabulary(spark, sf).select("term", "df", "total")


@query(
    "vocabulary_index",
    f"""WITH {POSTINGS_SQL}, {VOCABULARY_SQL}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM vocabulary""",
)
def vocabulary_index(spark, sf):
    return terms.vocabulary_index(_vocabulary(spark, sf)).select("term", F.col("term_idx").cast("bigint"))


@query("sublinear_tf", f"WITH {POSTINGS_SQL} SELECT id, term, round(1 + ln(n), 6) AS tf FROM postings")
def sublinear_tf(spark, sf):
    return postings(spark, sf).select("id", "term", F.round(terms.sublinear_tf(F.col("n")), 6).alias("tf"))


@query(
    "smooth_idf", f"WITH {POSTINGS_SQL}, {VOCABULARY_SQL} SELECT term, round(idf, 6) AS idf FROM vocabulary"
)
def smooth_idf(spark, sf):
    return _vocabulary(spark, sf).select("term", F.round("idf", 6).alias("idf"))


@query("tfidf", f"WITH {TFIDF_SQL} SELECT id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def tfidf(spark, sf):
    done = terms.tfidf(staged_bags(spark, sf), terms.count_rows(labels(spark, sf)))
    return done.select("id", "term", F.round("tfidf", 6).alias("tfidf"))


@query(
    "top_tfidf_terms",
    f"""WITH {TFIDF_SQL},
ranked AS (
  SELECT label, term, round(sum(tfidf), 5) AS weight FROM tfidf GROUP BY label, term)
SELECT label, term, weight, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, term) AS rank FROM ranked)
WHERE rank <= 10""",
)
def top_tfidf_terms(spark, sf):
    """The ten terms of largest total TF-IDF weight in every language."""
    done = terms.tfidf(staged_bags(spark, sf), terms.count_rows(labels(spark, sf)))
    sums = done.groupBy("label", "term").agg(F.round(F.sum("tfidf"), 5).alias("weight"))
    top = terms.top_features_per_class(sums, 10)
    return top.select("label", "term", "weight", F.col("rank").cast("bigint"))


@query(
    "legacy_term_counts",
    f"WITH {LEGACY_SQL} SELECT id, term, n FROM legacy_postings JOIN legacy_terms USING (term)",
)
def legacy_term_counts(spark, sf):
    """Counts of the older vectoriser's vocabulary."""
    bags = legacy_bags(spark, sf)
    kept = legacy_terms(bags).select("term")
    return bags.select("id", F.inline("bag")).join(kept, "term", "left_semi").select("id", "term", "n")


@query("legacy_stemmed_counts")
def legacy_stemmed_counts(spark, sf):
    """The same with every token stemmed."""
    bags = legacy_bags(spark, sf, stem=True)
    kept = legacy_terms(bags).select("term")
    return bags.select("id", F.inline("bag")).join(kept, "term", "left_semi").select("id", "term", "n")


_HELD_OUT = 0
FOLDS_SQL = """folds AS MATERIALIZED (
  SELECT doc_id AS id, lang AS label,
         CAST((row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || ':42')) - 1) % 5 AS INTEGER)
         AS fold
  FROM documents)"""
TRAIN_VOCABULARY_SQL = f"""{POSTINGS_SQL}, {FOLDS_SQL},
train_docs AS (SELECT count(*) AS n_docs FROM folds WHERE fold <> {_HELD_OUT}),
train_postings AS MATERIALIZED (
  SELECT p.* FROM postings p JOIN folds f USING (id) WHERE f.fold <> {_HELD_OUT}),
vocabulary AS MATERIALIZED (
  SELECT term, df, total, ln((1.0 + n_docs) / (1.0 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(n) AS total FROM train_postings GROUP BY term), train_docs
  WHERE df >= 3 AND df <= 0.9::DOUBLE * n_docs ORDER BY total DESC, term LIMIT 50000)"""


def _split(spark, sf):
    """Documents with their folds, and the postings with them."""
    folds = stage(stratified_kfold(labels(spark, sf)).select("id", "label", "fold"), "folds")
    return folds, folded_postings(spark, sf, folds)


@query(
    "transform_with_vocabulary",
    f"""WITH {TRAIN_VOCABULARY_SQL},
weighted AS (
  SELECT p.id, p.term, (1 + ln(n)) * idf AS w
  FROM postings p JOIN folds f USING (id) JOIN vocabulary v USING (term) WHERE f.fold = {_HELD_OUT}),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY id)
SELECT id, term, round(w / norm, 6) AS tfidf FROM weighted JOIN norms USING (id)""",
)
def transform_unseen(spark, sf):
    """Fold 0 under the vocabulary of the other folds."""
    folds = stage(stratified_kfold(labels(spark, sf)).select("id", "label", "fold"), "folds")
    bags = folded_bags(spark, sf, folds)
    train = bags.filter(F.col("fold") != _HELD_OUT)
    vocabulary = terms.fit_vocabulary(train.select("id", F.inline("bag")), terms.count_rows(train))
    done = terms.transform_with_vocabulary(bags.filter(F.col("fold") == _HELD_OUT), vocabulary)
    return done.select("id", "term", F.round("tfidf", 6).alias("tfidf"))


_MEANS_SQL = f"""WITH {TFIDF_SQL},
sizes AS (SELECT lang AS label, count(*) AS docs FROM documents GROUP BY lang),
means AS (
  SELECT label, term, round(sum(tfidf) / docs, 7) AS weight
  FROM tfidf JOIN sizes USING (label) GROUP BY label, term, docs)"""


@query(
    "top_features_per_class",
    f"""{_MEANS_SQL}
SELECT label, term, weight, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, term) AS rank FROM means)
WHERE rank <= 20""",
)
def top_features(spark, sf):
    """Terms of largest mean TF-IDF weight per class."""
    done = terms.tfidf(staged_bags(spark, sf), terms.count_rows(labels(spark, sf)))
    sizes = labels(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    weights = (
        done.groupBy("label", "term")
        .agg(F.sum("tfidf").alias("sum"))
        .join(sizes, "label")
        .select("label", "term", F.round(F.col("sum") / F.col("docs"), 7).alias("weight"))
    )
    return terms.top_features_per_class(weights).withColumn("rank", F.col("rank").cast("bigint"))


CHI2_SQL = """classes AS (SELECT lang AS label, count(*)::DOUBLE / (SELECT count(*) FROM documents) AS share
  FROM documents GROUP BY lang),
features AS (SELECT term, sum(n) AS total FROM postings GROUP BY term),
cells AS (SELECT term, label, sum(n) AS obs FROM postings GROUP BY term, label),
chi2 AS MATERIALIZED (
  SELECT f.term, CAST(f.total AS BIGINT) AS total,
         sum((coalesce(obs, 0) - share * f.total) * (coalesce(obs, 0) - share * f.total) / (share * f.total)) AS score
  FROM features f CROSS JOIN classes c LEFT JOIN cells x ON x.term = f.term AND x.label = c.label
  GROUP BY f.term, f.total)"""


def _chi2(spark, sf):
    return terms.chi2_scores(postings(spark, sf), labels(spark, sf))


@query("chi2_scores", f"WITH {POSTINGS_SQL}, {CHI2_SQL} SELECT term, total, round(score, 5) AS score FROM chi2")
def chi2_scores(spark, sf):
    return _chi2(spark, sf).select("term", "total", F.round("score", 5).alias("score"))


@query(
    "rank_features",
    f"""WITH {POSTINGS_SQL}, {CHI2_SQL}
SELECT term, round(score, 5) AS score FROM chi2 ORDER BY score DESC, term""",
)
def rank_features(spark, sf):
    ranked = terms.rank_features(_chi2(spark, sf))
    return ranked.select("term", F.round("score", 5).alias("score"))


# Scores are rounded before ranking, so that equal scores tie in both engines.
_TRAIN_CHI2_SQL = f"""WITH {POSTINGS_SQL}, {FOLDS_SQL},
train AS (SELECT * FROM folds WHERE fold <> {_HELD_OUT}),
train_postings AS MATERIALIZED (SELECT p.* FROM postings p JOIN train USING (id)),
classes AS (SELECT label, count(*)::DOUBLE / (SELECT count(*) FROM train) AS share FROM train GROUP BY label),
features AS (SELECT term, sum(n) AS total FROM train_postings GROUP BY term),
cells AS (SELECT term, label, sum(n) AS obs FROM train_postings GROUP BY term, label),
chi2 AS (
  SELECT f.term, round(sum((coalesce(obs, 0) - share * f.total) ** 2 / (share * f.total)), 4) AS score
  FROM features f CROSS JOIN classes c LEFT JOIN cells x ON x.term = f.term AND x.label = c.label
  GROUP BY f.term),
best AS MATERIALIZED (SELECT term, score FROM chi2 ORDER BY score DESC, term LIMIT 150)"""


def _rounded_chi2(train_postings, train_labels):
    scores = terms.chi2_scores(train_postings, train_labels)
    return scores.select("term", F.round("score", 4).alias("score"))


def _best(spark, sf):
    folds, split = _split(spark, sf)
    train = folds.filter(F.col("fold") != _HELD_OUT)
    return split, terms.select_k_best(
        split.filter(F.col("fold") != _HELD_OUT), train, score=_rounded_chi2
    )


@query(
    "select_k_best",
    f"""{_TRAIN_CHI2_SQL}
SELECT p.id, f.fold, p.term, p.n FROM postings p JOIN best USING (term) JOIN folds f USING (id)""",
)
def select_k_best(spark, sf):
    """Both sides of the split reduced to the terms chosen on the training side."""
    split, best = _best(spark, sf)
    return terms.reduce_to_terms(split, best).select("id", "fold", "term", "n")


@query(
    "selected_feature_names",
    f"""{_TRAIN_CHI2_SQL},
{DF_SQL.replace('stats AS', 'all_stats AS')},
all_vocabulary AS (
  SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM (
    SELECT term FROM all_stats, n_docs WHERE df >= 3 AND df <= 0.9::DOUBLE * n_docs
    ORDER BY total DESC, term LIMIT 50000))
SELECT v.term, v.term_idx FROM all_vocabulary v JOIN best USING (term)""",
)
def selected_names(spark, sf):
    split, best = _best(spark, sf)
    index = terms.vocabulary_index(terms.fit_vocabulary(split, terms.count_rows(labels(spark, sf))))
    return terms.selected_feature_names(index, best).select("term", F.col("term_idx").cast("bigint"))


def _labelled(spark, sf):
    return labels(spark, sf)


@query(
    "label_index_sorted",
    """SELECT doc_id AS id, lang AS label, dense_rank() OVER (ORDER BY lang) - 1 AS label_idx FROM documents""",
)
def label_index_sorted(spark, sf):
    docs = _labelled(spark, sf)
    index = encode.label_index_sorted(docs)
    return docs.join(index, "label").select("id", "label", F.col("label_idx").cast("bigint"))


@query(
    "label_index_first_seen",
    """WITH first AS (SELECT lang AS label, min(doc_id) AS seen FROM documents GROUP BY lang),
idx AS (SELECT label, row_number() OVER (ORDER BY seen) - 1 AS label_idx FROM first)
SELECT doc_id AS id, label, label_idx FROM documents JOIN idx ON lang = label""",
)
def label_index_first_seen(spark, sf):
    docs = _labelled(spark, sf)
    index = encode.label_index_first_seen(docs, "id")
    return docs.join(index, "label").select("id", "label", F.col("label_idx").cast("bigint"))


@query(
    "binarize_labels",
    "SELECT doc_id AS id, " + ", ".join(f"(lang = '{c}')::INTEGER AS is_{c}" for c in CLASSES) + " FROM documents",
)
def binarize_labels(spark, sf):
    return encode.binarize_labels(_labelled(spark, sf), CLASSES).drop("label")


@query(
    "label_distribution",
    """SELECT dense_rank() OVER (ORDER BY lang) - 1 AS label_idx, lang AS label, count(*) AS n
FROM documents GROUP BY lang""",
)
def label_distribution(spark, sf):
    done = encode.label_distribution(_labelled(spark, sf))
    return done.withColumn("label_idx", F.col("label_idx").cast("bigint"))


_ENCODED_SQL = f"""WITH {POSTINGS_SQL}, {DF_SQL},
vocab AS (
  SELECT term, row_number() OVER (ORDER BY term) + 3 AS token_id FROM (
    SELECT term FROM stats, n_docs WHERE df >= 3 AND df <= 0.9::DOUBLE * n_docs
    ORDER BY total DESC, term LIMIT 50000)),
pieces AS (
  SELECT id, unnest(list_slice(list_filter(toks, lambda x: length(x) >= 2), 1, 126)) AS term,
         generate_subscripts(list_slice(list_filter(toks, lambda x: length(x) >= 2), 1, 126), 1) AS pos
  FROM tokens),
coded AS (
  SELECT id, list(coalesce(token_id, 1) ORDER BY pos) AS ids
  FROM pieces LEFT JOIN vocab USING (term) GROUP BY id),
framed AS (
  SELECT t.id, list_concat(list_concat([2], coalesce(ids, [])), [3]) AS ids FROM tokens t LEFT JOIN coded USING (id))
SELECT id,
       array_to_string(list_concat(ids, list_transform(range(128 - len(ids)), lambda x: 0)), ' ') AS input_ids,
       array_to_string(list_transform(range(128), lambda x: CASE WHEN x < len(ids) THEN 1 ELSE 0 END), ' ')
         AS attention_mask,
       array_to_string(list_transform(range(128), lambda x: 0), ' ') AS token_type_ids
FROM framed"""


@query("encode_fixed_length", _ENCODED_SQL)
def encode_fixed_length(spark, sf):
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), clean_terms().alias("terms"))
    docs = stage(docs, "tokens")
    counted = terms.term_counts(docs, F.col("terms"))
    index = terms.vocabulary_index(terms.fit_vocabulary(counted, terms.count_rows(docs)))
    vocabulary = index.select("term", (F.col("term_idx") + encode.FIRST_TERM_ID).alias("token_id"))
    done = encode.encode_fixed_length(docs, F.col("terms"), vocabulary)
    return done.select(
        "id",
        *[
            F.array_join(F.transform(c, lambda x: x.cast("string")), " ").alias(c)
            for c in ("input_ids", "attention_mask", "token_type_ids")
        ],
    )
