"""Row numbers within groups that one task could not hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.session import stage

_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def _join_offsets(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach ``__``-columns of the offset table; null keys match each other."""
    renamed = offsets.withColumnsRenamed({key: f"__k_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"__k_{key}")) for key in keys]
    return rows.join(renamed, condition).drop(*[f"__k_{key}" for key in keys])


def staged_rank(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Exact row number (from 1) of every row in its ``by`` group, in ``order``.

    Range-sorts the rows, so a hot group spreads over many tasks, and stages the
    positions. A row's rank is its distance from the group's first row in the same
    sorted partition plus the group's rows in earlier partitions; that offset table
    has one row per (partition, group present in it). ``order`` must be total.
    """
    by = list(by)
    sort_keys = [F.col(c) if isinstance(c, str) else c for c in order]
    sorted_rows = df.sort(*by, *sort_keys).withColumn("__at", F.monotonically_increasing_id())
    staged = stage(sorted_rows, name).withColumns(
        {
            "__part": F.shiftright("__at", _POSITION_BITS),
            "__pos": F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    pieces = staged.groupBy("__part", *by).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn(
        "__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))
    ).drop("__rows")
    return (
        _join_offsets(staged, offsets, ["__part", *by])
        .withColumn(name, F.col("__before") + F.col("__pos") - F.col("__first") + 1)
        .drop("__at", "__part", "__pos", "__first", "__before")
    )


def hash_rank(df: DataFrame, by: Sequence[str], digest: Column, name: str = "rank", digits: int = 3) -> DataFrame:
    """Exact row number within ``by`` in the order of a uniform hex ``digest`` column.

    The leading digits cut every group into equal buckets in digest order, so the
    rank is the row number in a bucket plus the size of the buckets before it.
    """
    by = list(by)
    rows = df.withColumn("__digest", digest).withColumn("__bucket", F.left("__digest", F.lit(digits)))
    sizes = rows.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(
        "__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))
    ).drop("__rows")
    within = Window.partitionBy(*by, "__bucket").orderBy("__digest")
    return (
        rows.withColumn("__row", F.row_number().over(within))
        .transform(_join_offsets, offsets, [*by, "__bucket"])
        .withColumn(name, F.col("__before") + F.col("__row"))
        .drop("__digest", "__bucket", "__row", "__before")
    )


def seeded_digest(key: Column, seed: int) -> Column:
    """Reproducible shuffle order of unique keys."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
