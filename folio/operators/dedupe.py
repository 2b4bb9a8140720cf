"""Filters, deduplication, caps, samples and the extraction audit.

Keep-first rules are ``row_number() = 1`` filters: Spark prunes them to one row per
key in every map task before the shuffle (window group limit), so a URL shared by a
third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.config import MIN_BODY_CHARS, PAGE_SIZE
from folio.operators.ranking import staged_rank


# Tasks that share the first cut of one class.
CAP_SLICES = 256


def first_per_key(df: DataFrame, key: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in a total order."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def min_body_filter(df: DataFrame, min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    return df.filter(F.length("body") >= min_chars)


def class_rank(category: Column, classes: Sequence[str]) -> Column:
    """Position of a class in the configured order; unknown classes come last."""
    return F.coalesce(
        F.nullif(F.array_position(F.lit(list(classes)), category), F.lit(0)),
        F.lit(len(classes) + 1),
    )


def dedupe_url_accepted(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """First accepted record per URL over all classes in class order; blank URLs are all kept."""
    key = F.when(F.col("url") == "", F.concat(F.lit("#"), F.col("id").cast("string"))).otherwise(F.col("url"))
    return first_per_key(df, [key], [class_rank(F.col("category"), classes), "id"])


def dedupe_url_claimed(df: DataFrame, min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    """Per class the first occurrence claims the URL before short bodies are dropped."""
    # the length test travels as a flag; bodies are read again for the rows that stay
    narrow = df.select("id", "category", "url", (F.length("body") >= min_chars).alias("__long"))
    kept = first_per_key(narrow, ["category", "url"], ["id"]).filter("__long").select("id")
    return df.join(kept, "id", "left_semi")


def drop_duplicate_urls(df: DataFrame) -> DataFrame:
    """Global keep-first by URL in id order."""
    return first_per_key(df, ["url"], ["id"])


def dedupe_slug_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last write per class and slug wins."""
    return first_per_key(df, keys, [F.col(order).desc()])


def cap_per_class(df: DataFrame, limit: int, by: str = "category", order: str = "id") -> DataFrame:
    """At most ``limit`` rows per class in arrival order, however large the class."""
    # no slice of a class can add more than the limit, so slices are cut before the class meets
    rows = df.select(by, order).withColumn("__slice", F.pmod(F.xxhash64(order), F.lit(CAP_SLICES)))
    for keys in ([by, "__slice"], [by]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        rows = rows.withColumn("__place", place).filter(F.col("__place") <= limit).drop("__place")
    return df.join(rows.select(order), order, "left_semi")


def systematic_page_sample(
    df: DataFrame, by: Sequence[str], order: Sequence[str], target: int, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Pages spread evenly over a section's history, enough for ``target`` rows.

    Pages hold ``page_size`` rows; only full pages count (at least one). Adds ``page``.
    """
    ranked = staged_rank(df, by, order)
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
    joined = ranked.join(totals, list(by)) if by else ranked.withColumn("__total", totals.scalar())
    max_page = F.greatest(F.lit(1), F.floor(F.col("__total") / page_size))
    wanted = F.lit(max(1, -(-target // page_size)))
    needed = F.least(wanted, max_page)
    step = F.floor(max_page / needed)
    page = F.floor((F.col("rank") - 1) / page_size) + 1
    return (
        joined.withColumns({"page": page, "__step": step, "__needed": needed})
        .filter((F.col("page") - 1) % F.col("__step") == 0)
        .filter((F.col("page") - 1) / F.col("__step") < F.col("__needed"))
        .drop("rank", "__total", "__step", "__needed")
    )


def in_sampled_block(page: Column, block: int, skip: int, blocks: int) -> Column:
    """Pages inside one of ``blocks`` blocks of ``block`` pages with ``skip`` pages between."""
    return ((page - 1) % (block + skip) < block) & (page <= blocks * (block + skip))


def block_skip_sample(
    df: DataFrame, by: Sequence[str], order: Sequence[str], *, page_size: int = PAGE_SIZE,
    block: int = 5, skip: int = 20, blocks: int = 17,
) -> DataFrame:
    """Rows whose page falls in a sampled block. Adds ``page``."""
    page = F.floor((F.col("rank") - 1) / page_size) + 1
    return (
        staged_rank(df, by, order)
        .withColumn("page", page)
        .filter(in_sampled_block(F.col("page"), block, skip, blocks))
        .drop("rank")
    )


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def require_min_rows(df: DataFrame, minimum: int) -> DataFrame:
    """The frame itself, or an error when it has fewer than ``minimum`` rows."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise ValueError(f"need at least {minimum} rows, found {found}")
    return df


def extraction_audit(df: DataFrame, classes: Sequence[str], min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    """Accepted, short and duplicate rows per class under the accepted-URL rule."""
    seen = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(F.coalesce(F.length("body"), F.lit(0)) < min_chars).alias("short"),
    )
    narrow = min_body_filter(df, min_chars).select("id", "url", "category")
    accepted = dedupe_url_accepted(narrow, classes).groupBy("category").agg(F.count(F.lit(1)).alias("ok"))
    return (
        seen.join(accepted, "category", "left")
        .withColumn("accepted", F.coalesce("ok", F.lit(0)))
        .select(
            "category", "accepted", "short", (F.col("seen") - F.col("short") - F.col("accepted")).alias("duplicate")
        )
    )
