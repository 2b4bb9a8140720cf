"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import fresh, n_words
from folio.operators.ranking import hash_rank, staged_rank
from folio.session import stage

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
NEWTON_STEPS = 40
TOLERANCE = 1e-6
OFFSETS = 64


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, words, target`` from ``source, words``: one row per source.

    Sources by code point, null last, get the weights in turn. The targets share ``share`` of all words by weight;
    none exceeds ``max_repeat`` times its source, and what is over goes to the others by weight until none is above. That
    is one level L with target = min(cap, L * weight); each round fixes the sources that L puts above their cap and
    shares the rest anew, by two sums over the table.
    """
    ranked = staged_rank(sources.withColumn("missing", F.col("source").isNull()), [], ["missing", "source"], "place")
    cycle = F.lit([float(w) for w in weights])
    table = stage(
        ranked.select(
            "source",
            "words",
            F.get(cycle, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")).alias("weight"),
            (F.col("words") * max_repeat).alias("cap"),
        ),
        "mix-sources",
    )
    level, capped = 0.0, -1
    total = (table.agg(F.sum("words").alias("n")).first()["n"] or 0) * share
    while True:
        above = F.lit(level) * F.col("weight") >= F.col("cap")
        got = table.agg(
            F.sum(F.when(above, F.col("cap"))).alias("fixed"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("capped"),
        ).first()
        if not got["open"] or got["capped"] == capped:
            break
        level, capped = (total - (got["fixed"] or 0.0)) / got["open"], got["capped"]
    return table.select("source", "words", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def _rate(tilt: Column, size: Column, mean: Column, max_repeat: float) -> Column:
    return F.least(F.lit(float(max_repeat)), F.exp(F.least(tilt * size / mean, F.lit(50.0))))


def balance(bins: DataFrame, wanted: DataFrame, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, mean, target, tilt``: the solved dual.

    Of all rates r in [0, max_repeat] with sum(r * size) = target in a source, the ones of greatest entropy relative to
    taking every document once are r = min(max_repeat, exp(tilt * size / mean)), one tilt per source. The tilts
    are the unknowns of the convex dual; its gradient and curvature are sums over ``bins`` (``source, size, n``), one
    aggregation per Newton step for all sources at once. A step that leaves the bracket known from earlier gradients is
    replaced by the bracket's middle, so the iteration cannot diverge.
    """
    stats = bins.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    state = stats.alias("a").join(wanted.alias("b"), same).select(
        "a.source",
        "mean",
        "target",
        (F.col("target") >= F.col("words") * max_repeat * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("tilt"),
        # down here even the smallest sizes take almost nothing
        (F.lit(-60.0) * F.greatest("mean", F.lit(1.0))).alias("low"),
        # from here on even a document of one word reaches the cap
        (F.log(F.lit(float(max_repeat))) * F.col("mean") + 1e-6).alias("high"),
        F.lit(False).alias("done"),
    )
    schema = state.schema
    state = stage(state, "mix-tilts", schema)
    for _ in range(NEWTON_STEPS):
        r = _rate(F.col("tilt"), F.col("size"), F.col("mean"), max_repeat)
        words = F.col("size") * F.col("n") * r
        slope = F.when(r < max_repeat, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            bins.where("size > 0")
            .alias("a")
            .join(state.where("NOT done AND NOT full").alias("b"), same)
            .groupBy("b.source")
            .agg(F.sum(words).alias("got"), F.sum(slope).alias("slope"))
        )
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        # Newton on log(got) = log(target), which is nearly straight in the tilt
        newton = F.col("tilt") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        ends = F.col("got").isNull() | (F.abs(gap) <= F.col("target") * TOLERANCE)
        state = stage(
            state.alias("a")
            .join(sums.alias("b"), same, "left")
            .select(
                "a.source",
                "mean",
                "target",
                "full",
                F.when(ends, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"),
                F.when(ends, F.col("low")).otherwise(low).alias("low"),
                F.when(ends, F.col("high")).otherwise(high).alias("high"),
                ends.alias("done"),
            ),
            "mix-tilts",
            schema,
        )
        if state.where("NOT done AND NOT full").isEmpty():
            break
    # the order of sums may change the last digits of a tilt from run to run: they are cut off
    return state.select("source", "mean", "target", "full", F.round("tilt", 6).alias("tilt"))


def copies(bins: DataFrame, tilts: DataFrame, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, size, base, extra``: every document of a bin is taken ``base`` times, ``extra`` of them once more.

    Systematic rounding: along the bins of a source in order of size, the copies of a bin are what the rounded running
    sum of rates grows by, so errors of neighbours cancel. The offset at which the sum is rounded is free; of
    ``OFFSETS`` offsets each source takes the one whose words come nearest to its target.
    """
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    r = F.when(F.col("full"), F.lit(float(max_repeat))).otherwise(
        _rate(F.col("tilt"), F.col("size"), F.col("mean"), max_repeat)
    )
    up_to = Window.partitionBy("source").orderBy(F.desc("size"))
    sums = (
        bins.alias("a")
        .join(tilts.alias("b"), same)
        .select("a.source", "size", "n", "target", r.alias("rate"))
        .withColumn("sum", F.sum(F.col("rate") * F.col("n")).over(up_to))
    )
    sums = stage(sums, "mix-sums")

    def taken(offset: Column) -> Column:
        upper = F.floor(F.col("sum") + offset)
        lower = F.floor(F.col("sum") - F.col("rate") * F.col("n") + offset)
        # a sum may miss an integer by its last digits; no document is taken more often than the cap
        return F.least(F.greatest(upper - lower, F.lit(0)), F.col("n") * F.lit(int(max_repeat)))

    offset = (F.col("offset") + 0.5) / OFFSETS
    tried = (
        sums.where("size > 0")
        .withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))))
        .groupBy("source", "target", "offset")
        .agg(F.sum(F.col("size") * taken(offset)).alias("words"))
    )
    best = tried.groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("words") - F.col("target")).alias("gap"), "offset")).alias("best")
    )
    chosen = sums.alias("a").join(best.alias("b"), same, "left").select(
        "a.*", F.coalesce("best.offset", F.lit(OFFSETS // 2)).alias("offset")
    )
    n_taken = taken(offset)
    return chosen.select(
        "source",
        "size",
        F.floor(n_taken / F.col("n")).cast("long").alias("base"),
        (n_taken % F.col("n")).cast("long").alias("extra"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    max_repeat: int = MAX_REPEAT,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``id, size, source, text_hash, source_size, target, copies, taken``: how often the mix takes each row.

    Sizes count words; a null text has none. Rows of one source and size have one rate, so all sums run over bins
    (source, size): a hot source is as many bins as any other, and texts are read once. Which rows of a bin get its
    extra copies follows a hash of the id, ranked in hash buckets so that a bin of many copies spreads over tasks;
    equal ids there follow the order of their text's hash. A null source is a source of its own, the last one. Rows
    without words have rate 1 at any tilt and take no words. An empty table gives an empty mix.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.xxhash64(text_col).alias("text_hash"),
        ),
        "mix-rows",
    )
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.col("text_hash").cast("string")))
    bins = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-bins")
    sources = bins.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    wanted = stage(targets(sources, weights, share, max_repeat), "mix-targets")
    plan = copies(bins, balance(bins, wanted, max_repeat), max_repeat)
    a, b = F.col("a.source"), F.col("b.source")
    plan = plan.alias("a").join(wanted.alias("b"), a.eqNullSafe(b)).select(
        "a.source", "size", "base", "extra", F.col("words").alias("source_size"), "target"
    )
    ranked = hash_rank(rows, ["source", "size"], digest, "place")
    same_bin = a.eqNullSafe(b) & (F.col("a.size") == F.col("b.size"))
    count = F.col("base") + F.when(F.col("place") <= F.col("extra"), 1).otherwise(0)
    return (
        ranked.alias("a")
        .join(plan.alias("b"), same_bin)
        .select("a.id", "a.size", "a.source", "text_hash", "source_size", "target", count.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns.

    Counts are found by id, source and text hash. Of rows equal in all three one stands for all, as often as they are
    taken together.
    """
    key = ["id", "source", "text_hash"]
    mixed = mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    counts = stage(mixed.groupBy(*key).agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("rows")), "mix-counts")
    named = {c: fresh(docs, f"__{c}") for c in (*key, "copies", "wanted", "copy")}
    keyed = docs.withColumns({named["id"]: F.col(id_col), named["source"]: F.col(source_col), named["text_hash"]: F.xxhash64(text_col)})
    if not counts.where("rows > 1").isEmpty():
        keyed = keyed.dropDuplicates([named[c] for c in key])
    wanted = counts.where("copies > 0").select(F.struct(*key).alias(named["wanted"]), F.col("copies").alias(named["copies"]))
    same = [F.col(named[c]).eqNullSafe(F.col(named["wanted"])[c]) for c in key]
    return (
        keyed.join(wanted, same)
        .withColumn(named["copy"], F.explode(F.sequence(F.lit(1), F.col(named["copies"]))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
