"""Token ids and label encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.config import ENCODE_LENGTH

# Ids of the special tokens.
PAD, UNK, START, END = 0, 1, 2, 3
FIRST_TERM_ID = 4


def encode_fixed_length(
    df: DataFrame, tokens: Column, vocabulary: DataFrame, max_len: int = ENCODE_LENGTH
) -> DataFrame:
    """``id, input_ids, attention_mask, token_type_ids``, each of length ``max_len``.

    ``vocabulary`` is ``(term, token_id)``. Tokens past
    the length the encoding holds are cut before anything is shuffled; the pieces of a
    document are at most ``max_len - 2`` rows.
    """
    room = max_len - 2
    kept = df.select("id", F.posexplode_outer(F.slice(tokens, 1, room)).alias("pos", "term"))
    coded = kept.join(vocabulary, "term", "left").withColumn(
        "token_id", F.when(F.col("pos").isNotNull(), F.coalesce("token_id", F.lit(UNK)))
    )
    collected = coded.groupBy("id").agg(
        F.sort_array(
            F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "token_id")))
        ).alias("__pieces")
    )
    inner = F.transform("__pieces", lambda p: p["token_id"].cast("int"))
    framed = F.concat(F.array(F.lit(START)), inner, F.array(F.lit(END)))
    used = F.size("__pieces") + 2
    return collected.select(
        "id",
        F.concat(framed, F.array_repeat(F.lit(PAD), F.lit(max_len) - used)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_len) - used)
        ).alias("attention_mask"),
        F.array_repeat(F.lit(0), max_len).alias("token_type_ids"),
    )


def label_index_sorted(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, label_idx`` with indices in sorted order (label-sized sort)."""
    order = Window.orderBy(label)
    return df.select(label).distinct().withColumn("label_idx", F.row_number().over(order) - 1)


def label_index_first_seen(df: DataFrame, seq: str, label: str = "label") -> DataFrame:
    """``label, label_idx`` with indices by first appearance in ``seq`` order."""
    first = df.groupBy(label).agg(F.min(seq).alias("__first"))
    order = Window.orderBy("__first")
    return first.select(label, (F.row_number().over(order) - 1).alias("label_idx"))


def binarize_labels(df: DataFrame, classes: Sequence[str], label: str = "label") -> DataFrame:
    """One 0/1 column ``is_<class>`` per class."""
    return df.withColumns({f"is_{c}": F.coalesce(F.col(label) == c, F.lit(False)).cast("int") for c in classes})


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class index."""
    index = label_index_sorted(df, label)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(index, label).select("label_idx", label, "n")


def class_list(df: DataFrame, label: str = "label") -> list[str]:
    """The sorted label vocabulary."""
    return sorted(row[0] for row in df.select(label).distinct().filter(F.col(label).isNotNull()).collect())
