"""Term statistics over postings ``(id, [label,] term, n)``.

Postings come out of each document row without a shuffle (``count_ngrams``), so every
later aggregate starts from one row per document and term and combines map-side.
Joins with a vocabulary carry no hint: its measured size decides whether it is broadcast, and in
a shuffle adaptive execution splits frequent terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folio.config import K_BEST, MAX_DF, MAX_FEATURES, MIN_DF, TOP_FEATURES
from folio.functions.arrays import COUNTED_ROWS, count_ngrams, counted
from folio.operators.ranking import staged_rank
from folio.session import stage

WEIGHED_ROWS = 256  # documents weighed at once in a task
TALLIED_ROWS = 2048  # documents added up at once in a task


def term_bags(df: DataFrame, tokens: Column, keep: Sequence[str] = ("id",), *, ngram_range=(1, 1)) -> DataFrame:
    """Bag of words in the document's row: ``keep`` columns and ``bag``, an array of (term, n).

    A task gives its bags back a few rows at a time, so a worker's memory does not follow the batches it is given.
    """
    rows = df.select(*keep, tokens.alias("__tokens"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COUNTED_ROWS):
                part = batch.slice(start, COUNTED_ROWS)
                bag = counted(part.column("__tokens"), *ngram_range)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], bag], names=[*keep, "bag"])

    bag_type = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]))
    return rows.mapInArrow(count, T.StructType([*[rows.schema[c] for c in keep], T.StructField("bag", bag_type)]))


def term_counts(df: DataFrame, tokens: Column, keep: Sequence[str] = ("id",), *, ngram_range=(1, 1)) -> DataFrame:
    """Bag of words: ``keep`` columns, term, n."""
    items = count_ngrams(tokens, *ngram_range)
    return df.select(*keep, F.inline(items))


def document_frequency(postings: DataFrame) -> DataFrame:
    """``term, df, total`` of every term."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("n").alias("total")
    )


def bag_tallies(bags: DataFrame, by: Sequence[str] = (), ngram_range=(1, 1)) -> DataFrame:
    """``term, by, df, total``: documents and occurrences of every term (per ``by`` group) in the bags."""
    return partial_tallies(bags, by, ngram_range).groupBy("term", *by).agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def partial_tallies(bags: DataFrame, by: Sequence[str] = (), ngram_range=(1, 1)) -> DataFrame:
    """``bag_tallies`` of each Arrow batch of at most ``TALLIED_ROWS`` rows.

    The bags of a batch are added up by integer codes, so a row per batch, group and term meets the shuffle, not a posting.
    ``bags`` may have arrays of tokens (``words`` or ``terms``) instead, which are counted by ``ngram_range`` in the same task.
    """
    source = next(c for c in ("bag", "words", "terms") if c in bags.columns)
    kept = [bags.schema[c] for c in by]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, TALLIED_ROWS) for whole in batches for at in range(0, whole.num_rows, TALLIED_ROWS)):
            bag = batch.column(source)
            if source != "bag":
                bag = counted(bag, *ngram_range)
            lengths = bag.value_lengths().fill_null(0).to_numpy()
            flat = bag.flatten()
            if not len(flat):
                continue
            terms = flat.field("term").dictionary_encode()
            group, keys = np.zeros(batch.num_rows, dtype=np.int64), []
            for c in by:
                coded = batch.column(c).dictionary_encode("encode")
                keys.append(coded.dictionary)
                group = group * len(coded.dictionary) + coded.indices.to_numpy()
            size = len(terms.dictionary)
            cells = np.repeat(group, lengths) * size + terms.indices.to_numpy()
            n = flat.field("n").to_numpy()
            if (group.max() + 1) * size <= 16 * len(cells):  # few groups: counted by cell, without a sort
                dfs, totals = np.bincount(cells), np.bincount(cells, weights=n)
                found = np.flatnonzero(dfs)
                dfs, totals = dfs[found], totals[found]
            else:
                found, at = np.unique(cells, return_inverse=True)
                dfs, totals = np.bincount(at), np.bincount(at, weights=n)
            cell_group, term = np.divmod(found, size)
            columns = [terms.dictionary.take(pa.array(term))]
            for values in reversed(keys):
                cell_group, place = np.divmod(cell_group, len(values))
                columns.insert(1, values.take(pa.array(place)))
            counts = [pa.array(v.astype(np.int64)) for v in (dfs, totals)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names=["term", *by, "df", "total"])

    fields = [T.StructField("term", T.StringType()), *kept, T.StructField("df", T.LongType()), T.StructField("total", T.LongType())]
    return bags.select(*by, source).mapInArrow(tally, T.StructType(fields))


def prune_by_df(stats: DataFrame, n_docs: Column, min_df: int = MIN_DF, max_df: float = MAX_DF) -> DataFrame:
    """Terms in at least ``min_df`` documents and at most the ``max_df`` share of them."""
    return stats.filter((F.col("df") >= min_df) & (F.col("df") <= n_docs * F.lit(max_df)))


def top_vocabulary(stats: DataFrame, max_features: int | None = MAX_FEATURES) -> DataFrame:
    """The ``max_features`` most frequent terms; equal counts are kept in term order.

    Terms are counted per total first, a table with far fewer rows than terms, which tells the total at which the
    cut falls. Terms above it are filtered where they are; only those at it are ranked, by a range sort. ``stats`` is read
    several times: stage it if it is expensive.
    """
    if max_features is None:
        return stats
    sizes = stats.groupBy("total").agg(F.count(F.lit(1)).alias("terms"))
    through = F.sum("terms").over(Window.orderBy(F.desc("total")))
    cut = sizes.withColumn("through", through).filter(F.col("through") > max_features).orderBy(F.desc("total")).first()
    if cut is None:
        return stats
    spare = max_features - (cut["through"] - cut["terms"])
    above = stats.filter(F.col("total") > cut["total"])
    if not spare:
        return above
    ties = staged_rank(stats.filter(F.col("total") == cut["total"]), [], ["term"])
    return above.unionByName(ties.filter(F.col("rank") <= spare).select(*stats.columns))


def vocabulary_index(vocabulary: DataFrame) -> DataFrame:
    """Adds the lexicographic ``term_idx``, by a range sort."""
    return staged_rank(vocabulary, [], ["term"], "term_idx").withColumn("term_idx", F.col("term_idx") - 1)


def sublinear_tf(n: Column) -> Column:
    return 1 + F.log(n)


def smooth_idf(df: Column, n_docs: Column) -> Column:
    return F.log((1 + n_docs) / (1 + df)) + 1


def count_rows(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n_docs")).scalar()


def fit_vocabulary(
    postings: DataFrame, n_docs: Column, *, min_df: int = MIN_DF, max_df: float = MAX_DF,
    max_features: int | None = MAX_FEATURES, ngram_range=(1, 1),
) -> DataFrame:
    """``term, df, total, idf`` of the kept terms; ``postings`` may be bags or arrays of tokens, which are added up batch by batch."""
    tallied = {"bag", "words", "terms"} & set(postings.columns)
    stats = bag_tallies(postings, (), ngram_range) if tallied else document_frequency(postings)
    stats = stage(prune_by_df(stats, n_docs, min_df, max_df), "term-stats")
    kept = top_vocabulary(stats, max_features)
    return kept.withColumn("idf", smooth_idf(F.col("df"), n_docs))


def join_vocabulary(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings of known terms with their vocabulary columns; unknown terms drop out."""
    return postings.join(vocabulary, "term")


def tfidf_weights(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Unnormalised ``w`` = sublinear tf x idf."""
    return join_vocabulary(postings, vocabulary).withColumn("w", sublinear_tf(F.col("n")) * F.col("idf"))


def transform_with_vocabulary(bags: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """TF-IDF of documents under a fitted vocabulary, each document L2-normalised.

    ``bags`` has a ``bag`` (term, n) per document; the other columns are kept, with ``term, n, tfidf``. A document is
    weighed and normalised in its own row: no shuffle. The vocabulary is capped, so its terms and weights are collected
    and sent to every task; for one without a cap there is ``transform_postings``.
    """
    rows = vocabulary.select("term", "idf").collect()
    known = bags.sparkSession.sparkContext.broadcast(
        (pa.array([r["term"] for r in rows], pa.string()), np.array([r["idf"] for r in rows], float))
    )
    kept = [f for f in bags.schema.fields if f.name != "bag"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = known.value
        for whole in batches:
            # a few rows at a time: a worker's memory follows them, not the size of the batches it is given
            for start in range(0, whole.num_rows, WEIGHED_ROWS):
                batch = whole.slice(start, WEIGHED_ROWS)
                bag = batch.column("bag")
                row = np.repeat(np.arange(len(bag)), bag.value_lengths().fill_null(0).to_numpy())
                flat = bag.flatten()
                place = pc.index_in(flat.field("term"), value_set=terms)
                found = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
                taken = pa.array(found)
                n = flat.field("n").take(taken)
                w = (1.0 + np.log(n.to_numpy())) * idf[place.take(taken).to_numpy()]
                norm = np.sqrt(np.bincount(row[found], w * w, len(bag)))
                of = pa.array(row[found])
                columns = [batch.column(f.name).take(of) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, flat.field("term").take(taken), n, pa.array(w / norm[row[found]])],
                    names=[*[f.name for f in kept], "term", "n", "tfidf"],
                )

    n_type = bags.schema["bag"].dataType.elementType["n"].dataType
    added = [T.StructField("term", T.StringType()), T.StructField("n", n_type), T.StructField("tfidf", T.DoubleType())]
    return bags.mapInArrow(weigh, T.StructType([*kept, *added]))


def transform_postings(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """TF-IDF from postings under a vocabulary of any size: one shuffle of the pruned postings by document, for the norm."""
    weighted = tfidf_weights(postings, vocabulary)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return weighted.withColumn("tfidf", F.col("w") / norm).drop("w")


def tfidf(bags: DataFrame, n_docs: Column, *, max_features: int | None = MAX_FEATURES, **limits) -> DataFrame:
    """Fit on and transform the same documents; ``bags`` (``id, bag``) is read twice."""
    vocabulary = fit_vocabulary(bags, n_docs, max_features=max_features, **limits)
    if max_features is None:
        postings = bags.select("*", F.inline("bag")).drop("bag")
        return transform_postings(postings, vocabulary.select("term", "idf"))
    return transform_with_vocabulary(bags, vocabulary)


def top_features_per_class(weights: DataFrame, n: int = TOP_FEATURES, label: str = "label") -> DataFrame:
    """The n largest ``weight`` rows per class with their ``rank``."""
    order = Window.partitionBy(label).orderBy(F.desc("weight"), "term")
    return weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def chi2_scores(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Chi-square of every term against the classes: ``term, total, score``.

    Sum over classes of (obs - exp)^2 / exp equals sum(obs^2 / exp) - total, because
    observed and expected counts of a term both add up to its total. So only cells
    that occur are needed, never the terms x classes grid. Postings carry ``label``;
    ``labels`` has one row per document.
    """
    n_docs = count_rows(labels)
    shares = labels.groupBy("label").agg((F.count(F.lit(1)) / n_docs).alias("share"))
    cells = postings.groupBy("term", "label").agg(F.sum("n").alias("obs"))
    joined = cells.join(shares, "label")
    return (
        joined.groupBy("term")
        .agg(F.sum("obs").alias("total"), F.sum(F.col("obs") * F.col("obs") / F.col("share")).alias("__q"))
        .withColumn("score", F.col("__q") / F.col("total") - F.col("total"))
        .drop("__q")
    )


def fold_chi2_best(cells: DataFrame, docs: DataFrame, folds: int, k: int = K_BEST) -> list[list[str]]:
    """``select_k_best`` on the rows outside each fold, for all folds from one table of counts: the terms per fold, in term order.

    ``cells`` has ``term, label, fold, total``, ``docs`` a row per document with ``label, fold``. A fold's training counts are the
    totals minus its own.
    """
    outside = docs.groupBy("label").agg(F.array(*[F.count_if(F.col("fold") != f) for f in range(folds)]).alias("docs"))
    sizes = docs.agg(F.array(*[F.count_if(F.col("fold") != f) for f in range(folds)]).alias("n")).scalar()
    shares = outside.select("label", F.array(*[F.get("docs", F.lit(f)) / F.get(sizes, F.lit(f)) for f in range(folds)]).alias("share"))
    counts = cells.groupBy("term", "label").agg(
        *[F.sum(F.when(F.col("fold") != f, F.col("total")).otherwise(0)).alias(f"o{f}") for f in range(folds)]
    )
    squares = lambda f: F.when(F.col(f"o{f}") > 0, F.col(f"o{f}") * F.col(f"o{f}") / F.get("share", F.lit(f)))
    sums = counts.join(shares, "label").groupBy("term").agg(
        *[F.sum(f"o{f}").alias(f"t{f}") for f in range(folds)], *[F.sum(squares(f)).alias(f"q{f}") for f in range(folds)]
    )
    scores = stage(sums, "chi2-sums")
    best = []
    for f in range(folds):
        scored = scores.filter(F.col(f"t{f}") > 0).select("term", (F.col(f"q{f}") / F.col(f"t{f}") - F.col(f"t{f}")).alias("score"))
        best.append(sorted(r["term"] for r in rank_features(scored, k).collect()))  # at most k
    return best


def match_terms(bags: DataFrame, names: Sequence[str]) -> DataFrame:
    """The other columns of ``bags``, with ``g`` (places in the short list ``names``) and ``n`` of the listed terms of each bag."""
    known = bags.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))
    kept = [f for f in bags.schema.fields if f.name != "bag"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bag = batch.column("bag")
            row = np.repeat(np.arange(len(bag)), bag.value_lengths().fill_null(0).to_numpy())
            flat = bag.flatten()
            place = pc.index_in(flat.field("term"), value_set=known.value)
            found = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
            taken = pa.array(found)
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row[found], minlength=len(bag)))].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, place.take(taken)), pa.ListArray.from_arrays(offsets, flat.field("n").take(taken))]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *lists], names=[*[f.name for f in kept], "g", "n"])

    added = [T.StructField("g", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.LongType()))]
    return bags.select(*[f.name for f in kept], "bag").mapInArrow(match, T.StructType([*kept, *added]))


def rank_features(scores: DataFrame, top_n: int = -1) -> DataFrame:
    """Features by descending score; ``top_n=-1`` keeps all."""
    ordered = scores.orderBy(F.desc("score"), "term")
    return ordered if top_n == -1 else ordered.limit(top_n)


def select_k_best(
    train_postings: DataFrame, train_labels: DataFrame, k: int = K_BEST,
    score: Callable[[DataFrame, DataFrame], DataFrame] = chi2_scores,
) -> DataFrame:
    """The k best terms by a score fitted on the training rows only."""
    return rank_features(score(train_postings, train_labels), k)


def reduce_to_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the selected terms (at most k rows, broadcast)."""
    return postings.join(F.broadcast(terms.select("term")), "term", "left_semi")


def selected_feature_names(vocabulary: DataFrame, selected: DataFrame) -> DataFrame:
    """Names of the kept features in column order."""
    kept = vocabulary.join(F.broadcast(selected.select("term")), "term", "left_semi")
    return kept.orderBy("term_idx")
