"""Dense vectors: word averages, layer and token pooling, encoders.

Element-wise sums and means run in MLlib's ``Summarizer``, whose partial buffers have
one slot per dimension: no vector is exploded and hot groups combine map-side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.config import EMBED_BATCH
from folio.session import stage


def _dense(vec: Column) -> Column:
    return array_to_vector(vec.cast("array<double>"))


def mean_vectors(df: DataFrame, keys: Sequence[str], vec: str = "vec", weight: str | None = None) -> DataFrame:
    weights = [F.col(weight).cast("double")] if weight else []
    return df.groupBy(*keys).agg(
        vector_to_array(Summarizer.mean(_dense(F.col(vec)), *weights)).alias("vec")
    )


def sum_vectors(df: DataFrame, keys: Sequence[str], vec: str = "vec") -> DataFrame:
    return df.groupBy(*keys).agg(vector_to_array(Summarizer.sum(_dense(F.col(vec)))).alias("vec"))


def mean_word_vector(
    docs: DataFrame, postings: DataFrame, words: DataFrame, dim: int, *,
    denominator: str = "tokens",
) -> DataFrame:
    """``id, vec``: mean vector of a document's known tokens, zeros without any.

    ``docs`` has ``id`` (and ``text`` for ``denominator="chars"``, which divides the sum
    by the text length instead of the matched tokens).

    The table of words is staged, so its measured size decides the join: one that fits the tasks' memory is sent there and
    the postings stay where they are. The sums are plain columns, which add up to one row per document in the task that reads
    its postings; of the texts only their lengths are shuffled.
    """
    table = stage(words.select(F.col("word").alias("term"), F.col("vec").cast("array<double>").alias("vec")), "word-vectors")
    matched = postings.join(table, "term")
    sums = matched.groupBy("id").agg(
        F.sum("n").alias("__matched"),
        *[F.sum(F.col("n") * F.get("vec", F.lit(i))).alias(f"__s{i}") for i in range(dim)],
    )
    if denominator == "chars":
        joined = docs.select("id", F.length("text").alias("__chars")).join(sums, "id", "left")
        scale = F.col("__chars")
    else:
        joined, scale = docs.select("id").join(sums, "id", "left"), F.col("__matched")
    means = F.array(*[F.try_divide(F.col(f"__s{i}"), scale) for i in range(dim)])
    vec = F.when(F.col("__matched").isNotNull(), means).otherwise(F.array_repeat(F.lit(0.0), dim))
    return joined.select("id", vec.alias("vec"))


def concat_layers(hidden: DataFrame, keys: Sequence[str] = ("doc", "pos"), layers: Sequence[int] = (12, 11, 10, 9)) -> DataFrame:
    """Per token the given layers' vectors one after the other, in the given order.

    Only those layers are read; a group holds at most ``len(layers)`` rows.
    """
    rank = F.array_position(F.lit(list(layers)), F.col("layer"))
    return (
        hidden.filter(F.col("layer").isin(*layers))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "vec"))).alias("__parts"))
        .select(*keys, F.flatten(F.transform("__parts", lambda p: p["vec"])).alias("vec"))
    )


def sum_layers(hidden: DataFrame, keys: Sequence[str] = ("doc", "pos"), layers: Sequence[int] = (12, 11, 10, 9)) -> DataFrame:
    """Per token the sum of the given layers' vectors."""
    return sum_vectors(hidden.filter(F.col("layer").isin(*layers)), keys)


def pool_tokens(hidden: DataFrame, layer: int = 11) -> DataFrame:
    """Sentence vector: mean over tokens of the second-last of 13 layers."""
    return mean_vectors(hidden.filter(F.col("layer") == layer), ["doc"])


def combine_subwords(pieces: DataFrame, keys: Sequence[str] = ("doc", "word_id"), how: str = "mean") -> DataFrame:
    """Word vector from the vectors of its pieces."""
    if how == "mean":
        return mean_vectors(pieces, keys)
    if how == "sum":
        return sum_vectors(pieces, keys)
    raise ValueError(f"unknown combination {how!r}")


def embed_batch(
    df: DataFrame, text: str, make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = EMBED_BATCH, element: T.DataType = T.FloatType(),
) -> DataFrame:
    """Adds ``embedding`` from a user-supplied encoder, built once per Python worker."""
    encode = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(element), batch_size=batch_size
    )
    return df.withColumn("embedding", encode(F.col(text)))


def hashing_encoder(dim: int = 16) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Stand-in encoder without a model file: L2-normalised token hashing."""

    def make() -> Callable[[np.ndarray], np.ndarray]:
        from hashlib import md5

        def encode(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for row, text in enumerate(texts):
                for token in str(text).lower().split():
                    code = int(md5(token.encode()).hexdigest()[:8], 16)
                    out[row, code % dim] += 1.0 if code & 0x10000 else -1.0
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms == 0.0, 1.0, norms)

        return encode

    return make
