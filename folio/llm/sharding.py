"""Sharding by sampled splitters: near-equal bytes in every shard, equal texts together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import search
from folio.session import stage

SHARDS = 16
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
OVERFULL = 2.0

_MIN = -(1 << 63)


def _draw(rate: Column) -> Column:
    """A size-weighted draw that depends on the row alone, so that reruns agree."""
    u = F.pmod(F.xxhash64("h", "k", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    return u < rate


def _quantiles(sample: list, parts: int) -> list:
    """``parts - 1`` splitters that cut a sorted sample evenly; repeats fall together."""
    cuts = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    return sorted(set(cuts))


def assign_shards(
    docs: DataFrame,
    n_shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, size, crc, shard, slot`` of every row.

    The key of a row is (hash of its text, id): equal texts are neighbours. A size-weighted sample of the hashes
    gives splitters of ``n_shards * ranges_per_shard`` ranges. Their exact sizes show which ranges are overfull (a hot
    text, an unlucky sample); those are cut again at sampled keys, ids included, so a text copied into a third of the
    rows spreads over many ranges. Consecutive ranges fill the shards to the nearest boundary, so equal texts share a
    shard unless they fill more than a range. A row's slot is its rank in its range plus the rows of earlier ranges of
    the shard. Only keys and sizes are shuffled, never texts.

    What the driver holds is bounded by parameters: sampled keys and one row per range. A null text counts as empty
    (size 1), null ids sort first, rows equal in id and text take neighbouring slots, an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(_MIN)).alias("k"),
            F.xxhash64(text).alias("h"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("crc"),
        ),
        "shard-keys",
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    n_ranges = n_shards * ranges_per_shard
    fair = max(total / n_ranges, 1.0)
    rate = F.col("size") * (n_ranges * SAMPLES_PER_RANGE / max(total, 1))
    sample = sorted(r["h"] for r in rows.where(_draw(rate)).select("h").collect())
    ranged = rows.withColumn("r", search(F.col("h"), _quantiles(sample, n_ranges)))

    sizes = ranged.groupBy("r").agg(F.sum("size").alias("bytes")).collect()
    over = {r["r"]: -(-r["bytes"] // int(fair + 1)) for r in sizes if r["bytes"] > OVERFULL * fair}
    if over:
        drawn = (
            ranged.where(F.col("r").isin(list(over)) & _draw(F.col("size") * (SAMPLES_PER_RANGE / fair)))
            .select("r", "h", "k")
            .collect()
        )
        keys: dict[int, list] = {}
        for r in sorted((x["r"], x["h"], x["k"]) for x in drawn):
            keys.setdefault(r[0], []).append((r[1], r[2]))
        cuts = [(r, [{"h": h, "k": k} for h, k in _quantiles(keys.get(r, []), int(parts))]) for r, parts in over.items()]
        spark = docs.sparkSession
        cut_table = spark.createDataFrame(cuts, "r int, cuts array<struct<h:long,k:long>>")
        ranged = ranged.join(F.broadcast(cut_table), "r", "left").withColumn(
            "sub",
            F.when(F.col("cuts").isNull(), 0).otherwise(search(F.struct("h", "k"), F.col("cuts"))),
        ).drop("cuts")
    else:
        ranged = ranged.withColumn("sub", F.lit(0))

    # one row per range: at most a few thousand, whatever the input
    order = Window.orderBy("r", "sub")
    pieces = (
        ranged.groupBy("r", "sub")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .withColumn("middle", F.sum("bytes").over(order) - F.col("bytes") / 2)
        .withColumn("shard", F.least(F.floor(F.col("middle") * n_shards / max(total, 1)), F.lit(n_shards - 1)).cast("int"))
    )
    earlier = Window.partitionBy("shard").orderBy("r", "sub").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("r", "sub", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("r", "sub").orderBy("h", "k")
    return (
        ranged.withColumn("rank", F.row_number().over(within))
        .join(F.broadcast(pieces), ["r", "sub"])
        .select("id", "size", "crc", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"))
    )
