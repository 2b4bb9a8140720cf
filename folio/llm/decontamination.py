"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.tokens import groups, window_hash
from folio.session import stage

# A seed compares the positions marked 1: a changed word at a 0 does not disturb it.
MASKS = ("11101011", "11011101", "1110010111")
OVERLAP = 20
AGREE = 0.8
# Training seeds are looked up in a bitmap of this many bits before they are sent anywhere. Its size is fixed, whatever the
# benchmark; a fuller one lets more seeds through to the join, which decides.
FILTER_BITS = 26
_BUCKET = 1 << 15


def _seeds(rows: DataFrame, masks: Sequence[str], overlap: int, lookup=None) -> DataFrame:
    """``seed, id, at, words, around``: a row per mask and window, with the tokens around the window's start.

    ``around`` holds the low 32 bits of the ``overlap`` tokens before the start and the ``overlap`` from it on, 0 beyond
    the text. With ``lookup`` (a broadcast bitmap) only seeds whose bit is set are given.
    """
    keeps = [[i for i, c in enumerate(m) if c == "1"] for m in masks]
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(lookup.value, np.uint8) if lookup else None
        for batch in batches:
            for group in groups(batch.column(1)):
                padded = np.r_[np.zeros(overlap, np.uint32), group.tokens.astype(np.uint32) | 1, np.zeros(overlap, np.uint32)]
                seeds, places = [], []
                for number, keep in enumerate(keeps):
                    hashes = window_hash(group.tokens, keep, number)
                    fits = group.inside(keep[-1] + 1)[: len(hashes)]
                    if bits is not None:
                        place = hashes & np.uint64((1 << FILTER_BITS) - 1)
                        fits = fits & (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                    found = np.flatnonzero(fits)
                    seeds.append(hashes[found])
                    places.append(found)
                seed, place = np.concatenate(seeds), np.concatenate(places)
                for start in range(0, len(place), 1 << 14):
                    p = place[start : start + (1 << 14)]
                    around = padded[p[:, None] + np.arange(2 * overlap)]
                    inside = group.at[p][:, None] + np.arange(-overlap, overlap)
                    around[(inside < 0) | (inside >= group.counts[group.text[p]][:, None])] = 0
                    values = pa.array(around.ravel().view(np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, 2 * overlap, dtype=np.int32)), values)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seed[start : start + (1 << 14)].view(np.int64)),
                            batch.column(0).take(pa.array(group.rows[group.text[p]])),
                            pa.array(group.at[p]),
                            pa.array(group.counts[group.text[p]]),
                            lists,
                        ],
                        names=["seed", "id", "at", "words", "around"],
                    )

    return rows.mapInArrow(cut, f"seed long, id {id_type}, at long, words long, around array<int>")


def _filter_bitmap(seeds: DataFrame):
    """The seeds' bits as a broadcast of 2^FILTER_BITS bits, put together from built-in bitmap aggregates."""
    place = F.pmod("seed", F.lit(1 << FILTER_BITS)) + 1
    parts = (
        seeds.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bitmap = bytearray((1 << FILTER_BITS) // 8)
    for row in parts:
        start = (row["bucket"] - 1) * (_BUCKET // 8)
        bitmap[start : start + _BUCKET // 8] = row["bits"]
    return seeds.sparkSession.sparkContext.broadcast(bytes(bitmap))


def _verify(pairs: DataFrame, overlap: int, agree: float) -> DataFrame:
    """Of joined seeds, those inside an overlap that agrees in enough words, with the overlap's place in the document."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ours, theirs = (
                batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * overlap) for i in (4, 5)
            )
            at, item_at, item_words = (batch.column(i).to_numpy() for i in (1, 2, 3))
            same = (ours == theirs) & (theirs != 0)
            sums = np.c_[np.zeros(len(same), np.int64), np.cumsum(same, 1)]
            lengths = np.minimum(item_words, overlap)
            best, where = np.full(len(same), -1), np.zeros(len(same), np.int64)
            for length in np.unique(lengths):
                of = np.flatnonzero(lengths == length)
                # windows of the item that hold the seed's first word, by their distance from it
                back = np.arange(0, length)
                fits = (item_at[of][:, None] - back >= 0) & (item_at[of][:, None] - back + length <= item_words[of][:, None])
                got = sums[of][:, overlap - back + length] - sums[of][:, overlap - back]
                got = np.where(fits, got, -1)
                top = got.argmax(1)
                best[of], where[of] = got[np.arange(len(of)), top], -top
            good = best >= np.ceil(agree * lengths - 1e-9)
            kept = np.flatnonzero(good)
            start = at + where
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept)),
                    batch.column(6).take(pa.array(kept)),
                    pa.array(start[kept]),
                    pa.array((start + lengths)[kept]),
                    pa.array(best[kept] / np.maximum(lengths[kept], 1)),
                ],
                names=["id", "item", "start", "end", "agreement"],
            )

    id_type, item_type = (pairs.schema[c].dataType.simpleString() for c in ("id", "item"))
    ordered = pairs.select("id", "at", "item_at", "item_words", "around", "item_around", "item")
    return ordered.mapInArrow(check, f"id {id_type}, item {item_type}, start long, end long, agreement double")


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[str] = MASKS,
    overlap: int = OVERLAP,
    agree: float = AGREE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``id, item, start, end, agreement``: each document and item that overlap, the words from the first to the last overlap.

    Words count without case and without punctuation at their ends. A document overlaps an item if, somewhere, ``overlap``
    words in a row (all words of a shorter item) agree in at least the share ``agree``, word by word at one
    distance, and some mask finds a seed there. Every window of every document is hashed under every mask; those whose bit
    is set in the benchmark's bitmap are joined with the benchmark's seeds and compared, so what is sent grows with the
    overlaps and never with all windows. A hot item meets each document once per seed; no two documents meet.

    Items of fewer words than the shortest mask tell nothing and match nothing; a null or empty text matches nothing. Equal
    items are both reported. Rows of one id are reported together. Empty tables give no rows.
    """
    def side(df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary"))

    seeds = stage(_seeds(side(benchmark, item_col, item_text_col), masks, overlap), "benchmark-seeds")
    lookup = _filter_bitmap(seeds)
    hits = _seeds(side(docs, id_col, text_col), masks, overlap, lookup)
    item_seeds = seeds.select(
        "seed",
        F.col("id").alias("item"),
        F.col("at").alias("item_at"),
        F.col("words").alias("item_words"),
        F.col("around").alias("item_around"),
    )
    found = _verify(hits.join(item_seeds, "seed"), overlap, agree)
    return found.groupBy("id", "item").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("agreement").alias("agreement")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id overlaps no benchmark item; null ids compare equal."""
    hit = stage(contaminations(docs, benchmark, id_col=id_col, **options).select("id").distinct(), "contaminated")
    return docs.alias("d").join(hit.alias("h"), F.col(f"d.{id_col}").eqNullSafe(F.col("h.id")), "left_anti")
