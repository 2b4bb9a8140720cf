"""The result report as an ordered table of lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.evaluation.descriptive import class_counts, date_range, token_overview
from folio.evaluation.metrics import leaderboard


def _row(*cells: Column | str) -> Column:
    """A table line of the cells."""
    parts: list[Column] = [F.lit("|")]
    for cell in cells:
        value = F.lit(cell) if isinstance(cell, str) else cell.cast("string")
        parts += [F.lit(" "), value, F.lit(" |")]
    return F.concat(*parts)


def _fixed(df: DataFrame, section: int, lines: list[str]) -> DataFrame:
    """Constant lines of a section."""
    return df.sparkSession.range(1).select(
        F.lit(section).alias("section"), F.posexplode(F.lit(lines)).alias("ord", "line")
    )


def _numbered(df: DataFrame, section: int, order: list[Column | str], line: Column) -> DataFrame:
    """Lines of a result-sized table in order."""
    return df.select(
        F.lit(section).alias("section"), F.row_number().over(Window.orderBy(*order)).alias("ord"), line.alias("line")
    )


def report_lines(corpus: DataFrame, cv: DataFrame, temporal: DataFrame | None = None) -> DataFrame:
    """``section, ord, line``, sorted: corpus tables, leaderboard, temporal metrics.

    ``corpus`` has category, date and n_tokens; ``cv`` is a ``cv_summary``; ``temporal``
    a ``temporal_validation`` result, or None for a placeholder line. Every input but
    the corpus is result-sized, and the corpus is only aggregated.
    """
    overall = date_range(corpus).filter(F.col("category") == "*")
    three = "%.3f"
    parts = [
        _fixed(corpus, 10, ["## Dataset", "", "| Class | Articles |", "|---|---:|"]),
        _numbered(class_counts(corpus), 11, ["category"], _row(F.col("category"), F.col("n"))),
        _numbered(
            overall, 12, ["category"], F.format_string("Date range: %s → %s", "first_day", "last_day")
        ),
        _numbered(
            token_overview(corpus), 13, ["median_tokens"],
            F.format_string("Median tokens per article: %s", F.bround(F.coalesce("median_tokens", F.lit(0.0))).cast("int")),
        ),
        _fixed(
            corpus, 20, ["## Cross-validation", "", "| Model | Accuracy | Macro F1 | Weighted F1 |", "|---|:---:|:---:|:---:|"]
        ),
        _numbered(
            leaderboard(cv), 21, ["rank"],
            _row(F.col("model"), F.col("accuracy"), F.col("macro_f1"), F.col("weighted_f1")),
        ),
        _numbered(
            leaderboard(cv).filter("rank = 1"), 22, ["rank"], F.format_string("Best model: %s (by macro F1)", "model")
        ),
        _fixed(corpus, 30, ["## Temporal validation", ""]),
    ]
    if temporal is None:
        parts.append(_fixed(corpus, 31, ["Temporal results are not available."]))
    else:
        run = temporal.select(
            "model", "train_size", "test_size", "accuracy", "macro_f1", "weighted_f1"
        ).distinct()
        metrics = [
            ("Model", F.col("model")),
            ("Train", F.col("train_size").cast("string")),
            ("Test", F.col("test_size").cast("string")),
            ("Accuracy", F.format_string(three, "accuracy")),
            ("Macro F1", F.format_string(three, "macro_f1")),
            ("Weighted F1", F.format_string(three, "weighted_f1")),
        ]
        lines = F.array(F.lit("| Metric | Value |"), F.lit("|---|---:|"), *[_row(n, v) for n, v in metrics])
        parts += [
            run.select(F.lit(31).alias("section"), F.posexplode(lines).alias("ord", "line")),
            _fixed(corpus, 32, ["", "| Class | Precision | Recall | F1 |", "|---|:---:|:---:|:---:|"]),
            _numbered(
                temporal, 33, ["class"],
                _row(F.col("class"), *[F.format_string(three, c) for c in ("precision", "recall", "f1")]),
            ),
        ]
    return reduce(DataFrame.unionByName, parts).orderBy("section", "ord")


def write_report(lines: DataFrame, path: str) -> None:
    """The report as one text file under ``path`` (a few dozen lines)."""
    lines.orderBy("section", "ord").select("line").coalesce(1).write.mode("overwrite").text(path)
