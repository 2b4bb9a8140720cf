"""Classification metrics over predictions derived from the documents."""

from functools import reduce

from pyspark.sql import functions as F

from folio.evaluation import metrics
from folio.operators import splits
from folio.plans.inputs import CLASSES
from folio.plans.registry import query

# Models m7, m11, m13 miss every 7th, 11th, 13th document, and confuse some with French.
PREDICTIONS_SQL = """predictions AS MATERIALIZED (
  SELECT 'm' || m AS model, CAST(doc_id % 5 AS INTEGER) AS fold, doc_id AS id, lang AS y,
         CASE WHEN doc_id % m = 0 THEN 'en' WHEN doc_id % 5 = 3 THEN 'fr' ELSE lang END AS p
  FROM documents, (SELECT unnest([7, 11, 13]) AS m))"""


def predictions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    doc = F.col("doc_id")

    return docs.select("doc_id", "lang", F.explode(F.lit([7, 11, 13])).alias("m")).select(
        F.concat(F.lit("m"), F.col("m").cast("string")).alias("model"),
        (doc % 5).cast("int").alias("fold"),
        doc.alias("id"),
        F.col("lang").alias("y"),
        F.when(doc % F.col("m") == 0, F.lit("en"))
        .when(doc % 5 == 3, F.lit("fr"))
        .otherwise(F.col("lang"))
        .alias("p"),
    )


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Class figures per run; {0} are the keys of a run.
_REPORT_SQL = """, sides AS (
  SELECT {0}, y AS class, 1 AS support, 0 AS predicted, (y = p)::INTEGER AS tp FROM predictions
  UNION ALL SELECT {0}, p, 0, 1, 0 FROM predictions),
report AS (
  SELECT {0}, class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(support) AS BIGINT) AS support,
         CAST(sum(predicted) AS BIGINT) AS predicted,
         coalesce(sum(tp) / nullif(sum(predicted), 0), 0) AS "precision",
         coalesce(sum(tp) / nullif(sum(support), 0), 0) AS recall,
         coalesce(2 * sum(tp) / nullif(sum(support) + sum(predicted), 0), 0) AS f1
  FROM sides GROUP BY {0}, class),
scores AS (
  SELECT {0}, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1,
         sum(f1 * support) / sum(support) AS weighted_f1
  FROM report GROUP BY {0})"""


@query(
    "accuracy",
    f"WITH {PREDICTIONS_SQL} SELECT model, round(avg((y = p)::INTEGER), 6) AS accuracy FROM predictions GROUP BY model",
)
def accuracy(spark, sf):
    return rounded(metrics.accuracy(predictions(spark, sf), ["model"]), "accuracy")


@query(
    "class_report",
    f"""WITH {PREDICTIONS_SQL}{_REPORT_SQL.format('model')}
SELECT model, class, tp, support, predicted, round("precision", 6) AS "precision", round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM report""",
)
def class_report(spark, sf):
    return rounded(metrics.class_report(predictions(spark, sf), ["model"]), "precision", "recall", "f1")


@query(
    "macro_f1",
    f"WITH {PREDICTIONS_SQL}{_REPORT_SQL.format('model')} SELECT model, round(macro_f1, 6) AS macro_f1 FROM scores",
)
def macro_f1(spark, sf):
    return rounded(metrics.macro_f1(predictions(spark, sf), ["model"]), "macro_f1")


@query(
    "weighted_f1",
    f"WITH {PREDICTIONS_SQL}{_REPORT_SQL.format('model')} SELECT model, round(weighted_f1, 6) AS weighted_f1 FROM scores",
)
def weighted_f1(spark, sf):
    return rounded(metrics.weighted_f1(predictions(spark, sf), ["model"]), "weighted_f1")


_PIVOT_SQL = ", ".join(f"count(*) FILTER (p = '{c}') AS pred_{c}" for c in CLASSES)


@query("confusion_matrix", f"WITH {PREDICTIONS_SQL} SELECT model, y, {_PIVOT_SQL} FROM predictions GROUP BY model, y")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), CLASSES, ["model"])


_SHARE_SQL = ", ".join(f"round(count(*) FILTER (p = '{c}') / count(*), 6) AS pred_{c}" for c in CLASSES)


@query(
    "confusion_normalized", f"WITH {PREDICTIONS_SQL} SELECT model, y, {_SHARE_SQL} FROM predictions GROUP BY model, y"
)
def confusion_normalized(spark, sf):
    done = metrics.confusion_normalized(predictions(spark, sf), CLASSES, ["model"])
    return rounded(done, *[f"pred_{c}" for c in CLASSES])


_CV_CLASSES = (*CLASSES, "it")


@query(
    "cv_confusion_mean",
    f"""WITH {PREDICTIONS_SQL},
cells AS (SELECT model, fold, y, p, count(*) AS n FROM predictions GROUP BY ALL),
shares AS (SELECT model, fold, y, p, n / sum(n) OVER (PARTITION BY model, fold, y) AS share FROM cells),
grid AS (
  SELECT model, y FROM (SELECT DISTINCT model FROM predictions), (SELECT unnest({list(_CV_CLASSES)}) AS y))
SELECT g.model, g.y, """
    + ", ".join(
        f"round(coalesce(sum(share) FILTER (p = '{c}'), 0) / 5, 6) AS pred_{c}" for c in _CV_CLASSES
    )
    + " FROM grid g LEFT JOIN shares s ON s.model = g.model AND s.y = g.y GROUP BY g.model, g.y",
)
def cv_confusion_mean(spark, sf):
    done = metrics.cv_confusion_mean(predictions(spark, sf), _CV_CLASSES, 5)
    return rounded(done, *[f"pred_{c}" for c in _CV_CLASSES])


CV_SUMMARY_SQL = f"""{PREDICTIONS_SQL}{_REPORT_SQL.format('model, fold')},
summary AS (
  SELECT model, """ + ", ".join(
    f"round(avg({m}), 4) AS {m}_mean, round(stddev_pop({m}), 4) AS {m}_std"
    for m in ("accuracy", "macro_f1", "weighted_f1")
) + " FROM scores GROUP BY model)"


@query("cv_summary", f"WITH {CV_SUMMARY_SQL} SELECT * FROM summary")
def cv_summary(spark, sf):
    return metrics.cv_summary(predictions(spark, sf))


@query(
    "auc_hard",
    f"""WITH {PREDICTIONS_SQL},
classes AS (SELECT DISTINCT model, y AS class FROM predictions)
SELECT model, class, round((
  avg((p = class)::INTEGER) FILTER (y = class) + avg((p <> class)::INTEGER) FILTER (y <> class)) / 2, 6) AS auc
FROM classes JOIN predictions USING (model) GROUP BY model, class""",
)
def auc_hard(spark, sf):
    return rounded(metrics.auc_hard(predictions(spark, sf), ["model"]), "auc")


@query(
    "mean_fold_accuracy",
    f"""WITH {PREDICTIONS_SQL}
SELECT model, round(avg(a), 6) AS mean_accuracy FROM (
  SELECT model, fold, avg((y = p)::INTEGER) AS a FROM predictions GROUP BY model, fold) GROUP BY model""",
)
def mean_fold_accuracy(spark, sf):
    return rounded(metrics.mean_fold_accuracy(predictions(spark, sf)), "mean_accuracy")


@query(
    "mean_batch_accuracy",
    f"""WITH {PREDICTIONS_SQL},
batched AS (SELECT *, (row_number() OVER (PARTITION BY model ORDER BY id) - 1) // 32 AS batch FROM predictions)
SELECT model, round(avg(a), 6) AS mean_accuracy FROM (
  SELECT model, batch, avg((y = p)::INTEGER) AS a FROM batched GROUP BY model, batch) GROUP BY model""",
)
def mean_batch_accuracy(spark, sf):
    batched = splits.assign_batches(predictions(spark, sf), ["model"], ["id"])
    return rounded(metrics.mean_batch_accuracy(batched, ["model"]), "mean_accuracy")


@query(
    "epoch_stats",
    """WITH log AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS epoch,
         CASE WHEN event_type IN ('click', 'view') THEN 'train' ELSE 'valid' END AS phase,
         value AS loss, (event_id % 10) / 10.0::DOUBLE AS accuracy FROM events)
SELECT epoch, round(avg(loss) FILTER (phase = 'train'), 6) AS train_loss,
       round(avg(loss) FILTER (phase = 'valid'), 6) AS valid_loss,
       round(avg(accuracy) FILTER (phase = 'valid'), 6) AS valid_accuracy FROM log GROUP BY epoch""",
)
def epoch_stats(spark, sf):
    event = spark.read.parquet(f"{sf}/events.parquet")
    log = event.select(
        (F.col("user_id") % 4).cast("int").alias("epoch"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("train")).otherwise(F.lit("valid")).alias("phase"),
        F.col("value").alias("loss"),
        ((F.col("event_id") % 10) / F.lit(10.0)).alias("accuracy"),
    )
    return rounded(metrics.epoch_stats(log), "train_loss", "valid_loss", "valid_accuracy")


@query(
    "best_model",
    f"""WITH {CV_SUMMARY_SQL}
SELECT model, macro_f1_mean FROM summary ORDER BY macro_f1_mean DESC, model LIMIT 1""",
)
def best_model(spark, sf):
    results = metrics.cv_summary(predictions(spark, sf)).withColumn("ord", F.col("model"))
    return metrics.best_model(results)


@query(
    "leaderboard",
    f"""WITH {CV_SUMMARY_SQL}
SELECT row_number() OVER (ORDER BY macro_f1_mean DESC, model) AS rank, model, """
    + ", ".join(f"printf('%.3f±%.3f', {m}_mean, {m}_std) AS {m}" for m in ("accuracy", "macro_f1", "weighted_f1"))
    + " FROM summary",
)
def leaderboard(spark, sf):
    board = metrics.leaderboard(metrics.cv_summary(predictions(spark, sf)))
    return board.withColumn("rank", F.col("rank").cast("bigint"))


# Pseudo-random class probabilities: digits of a hash, normalised per (model, id).
PROBABILITIES_SQL = f"""raw AS (
  SELECT model, doc_id AS id, label,
         ('0x' || left(md5(model || ':' || doc_id || ':' || label), 4))::INTEGER + 1 AS h
  FROM documents, (SELECT unnest(['a', 'b']) AS model), (SELECT unnest({list(CLASSES)}) AS label)),
probabilities AS MATERIALIZED (
  SELECT model, id, label, h::DOUBLE / sum(h) OVER (PARTITION BY model, id) AS prob FROM raw)"""


def probabilities(spark, sf):
    """``model, id, scores``: an array of class probabilities per document."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"))
    runs = docs.select("id", F.explode(F.lit(["a", "b"])).alias("model"))

    def raw(label):
        digest = F.md5(F.concat_ws(":", "model", F.col("id").cast("string"), F.lit(label)))
        return F.conv(F.left(digest, F.lit(4)), 16, 10).cast("bigint") + 1

    hashes = [raw(label) for label in CLASSES]
    total = reduce(lambda a, b: a + b, hashes)
    return runs.select("model", "id", F.array(*[h / total for h in hashes]).alias("scores"))
