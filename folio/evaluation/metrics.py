"""Classification metrics as aggregations over predictions.

Input is ``(*keys, y, p)`` where ``keys`` name the runs (model, fold). Everything
starts from confusion cells, which combine map-side to a handful of rows per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def confusion_cells(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, y, p, n`` of the cells that occur."""
    return predictions.groupBy(*keys, "y", "p").agg(F.count(F.lit(1)).alias("n"))


def ratio(a: Column, b: Column) -> Column:
    """a / b with a zero denominator giving 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def accuracy(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    hit = F.coalesce(F.col("y") == F.col("p"), F.lit(False)).cast("int")
    return predictions.groupBy(*keys).agg(F.avg(hit).alias("accuracy"))


def class_report(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per class ``tp, support, predicted, precision, recall, f1``; zero denominators give 0."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("y").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.cast("bigint").alias("tp")
        ),
        F.struct(
            F.col("p").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")
        ),
    )
    counts = (
        confusion_cells(predictions, keys)
        .select(*keys, F.inline(sides))
        .filter(F.col("class").isNotNull())
        .groupBy(*keys, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return counts.withColumns(
        {
            "precision": ratio(tp, predicted),
            "recall": ratio(tp, support),
            "f1": ratio(2 * tp, support + predicted),
        }
    )


def macro_f1(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return class_report(predictions, keys).groupBy(*keys).agg(F.avg("f1").alias("macro_f1"))


def weighted_f1(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    weighted = ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support"))
    return class_report(predictions, keys).groupBy(*keys).agg(weighted.alias("weighted_f1"))


def summary_scores(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``accuracy, macro_f1, weighted_f1`` and ``size`` per run, in one pass."""
    report = class_report(predictions, keys)
    return report.groupBy(*keys).agg(
        F.sum("support").alias("size"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )


def _matrix(cells: DataFrame, keys: Sequence[str], classes: Sequence[str], value: Column) -> DataFrame:
    columns = [
        F.coalesce(F.sum(F.when(F.col("p") == c, value)), F.lit(0)).alias(f"pred_{c}") for c in classes
    ]
    return cells.groupBy(*keys, "y").agg(*columns)


def confusion_matrix(predictions: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Counts: a row per true class, a ``pred_<class>`` column per predicted class."""
    return _matrix(confusion_cells(predictions, keys), keys, classes, F.col("n"))


def normalized_cells(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cells with ``share`` of their true class's row."""
    row = Window.partitionBy(*keys, "y")
    return confusion_cells(predictions, keys).withColumn("share", F.col("n") / F.sum("n").over(row))


def confusion_normalized(predictions: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Row-normalised confusion matrix."""
    cells = normalized_cells(predictions, keys)
    matrix = _matrix(cells, keys, classes, F.col("share"))
    return matrix.withColumns({f"pred_{c}": F.col(f"pred_{c}").cast("double") for c in classes})


def cv_confusion_mean(
    predictions: DataFrame, classes: Sequence[str], n_folds: int, keys: Sequence[str] = ("model",)
) -> DataFrame:
    """Mean over folds of the row-normalised matrices for a fixed class list.

    A class absent from a fold contributes 0 there, and a class absent everywhere
    still has its row.
    """
    folded = _matrix(normalized_cells(predictions, [*keys, "fold"]), keys, classes, F.col("share"))
    means = folded.withColumns({f"pred_{c}": F.col(f"pred_{c}") / n_folds for c in classes})
    rows = predictions.select(*keys).distinct().select(*keys, F.explode(F.lit(list(classes))).alias("y"))
    return rows.join(means, [*keys, "y"], "left").na.fill(0.0)


def cv_summary(predictions: DataFrame, keys: Sequence[str] = ("model",), digits: int = 4) -> DataFrame:
    """Mean and population standard deviation over folds of the three scores."""
    folds = summary_scores(predictions, [*keys, "fold"])
    columns = []
    for metric in ("accuracy", "macro_f1", "weighted_f1"):
        columns.append(F.round(F.avg(metric), digits).alias(f"{metric}_mean"))
        columns.append(F.round(F.stddev_pop(metric), digits).alias(f"{metric}_std"))
    return folds.groupBy(*keys).agg(*columns)


def auc_hard(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per true class the ROC area of 0/1 predictions, which is (TPR + TNR) / 2."""
    report = class_report(predictions, keys).filter(F.col("support") > 0)
    total = F.sum("support").over(Window.partitionBy(*keys))
    negatives = F.col("total") - F.col("support")
    true_negatives = negatives - (F.col("predicted") - F.col("tp"))
    return (
        report.withColumn("total", total)
        .withColumn("auc", (F.col("tp") / F.col("support") + F.try_divide(true_negatives, negatives)) / 2)
        .select(*keys, "class", "auc")
    )


def auc_binary(decisions: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per class the ROC area of independent 0/1 decisions (one binary machine per class), (1 + TPR - FPR) / 2.

    ``decisions`` has ``y`` and ``decided``, an array of 0/1 in class order: a row may be given no class or several.
    A class without positive or without negative rows in a group has a null area.
    """
    rows = decisions.select(*keys, "y", F.posexplode("decided").alias("c", "d"))
    rows = rows.withColumn("class", F.get(F.lit(list(classes)), F.col("c"))).withColumn("pos", F.col("y") == F.col("class"))
    rates = rows.groupBy(*keys, "class").agg(
        F.try_divide(F.sum(F.when(F.col("pos"), F.col("d"))), F.count_if(F.col("pos"))).alias("tpr"),
        F.try_divide(F.sum(F.when(~F.col("pos"), F.col("d"))), F.count_if(~F.col("pos"))).alias("fpr"),
    )
    return rates.select(*keys, "class", ((1 + F.col("tpr") - F.col("fpr")) / 2).alias("auc"))


def mean_fold_accuracy(predictions: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    return accuracy(predictions, [*keys, "fold"]).groupBy(*keys).agg(F.avg("accuracy").alias("mean_accuracy"))


def mean_batch_accuracy(batched: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of the batch accuracies (a short last batch counts in full)."""
    return accuracy(batched, [*keys, "batch"]).groupBy(*keys).agg(F.avg("accuracy").alias("mean_accuracy"))


def epoch_stats(log: DataFrame) -> DataFrame:
    """Per epoch mean train and validation loss and mean validation accuracy."""

    def mean_in(phase: str, value: str) -> Column:
        return F.avg(F.when(F.col("phase") == phase, F.col(value)))

    return log.groupBy("epoch").agg(
        mean_in("train", "loss").alias("train_loss"),
        mean_in("valid", "loss").alias("valid_loss"),
        mean_in("valid", "accuracy").alias("valid_accuracy"),
    )


def best_model(results: DataFrame, order: str = "ord") -> DataFrame:
    """Model with the highest mean macro F1; the first in insertion order wins ties."""
    return results.orderBy(F.desc("macro_f1_mean"), order).limit(1).select("model", "macro_f1_mean")


def leaderboard(results: DataFrame, ascending: bool = False) -> DataFrame:
    """Models ranked by macro F1 with formatted mean±std columns."""
    key = F.col("macro_f1_mean")
    # one row per model
    rank = Window.orderBy(key.asc() if ascending else key.desc(), "model")
    formatted = [
        F.format_string("%.3f±%.3f", f"{metric}_mean", f"{metric}_std").alias(metric)
        for metric in ("accuracy", "macro_f1", "weighted_f1")
    ]
    return results.select(F.row_number().over(rank).alias("rank"), "model", *formatted).orderBy("rank")
