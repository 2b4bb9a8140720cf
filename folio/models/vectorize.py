"""Text to sparse feature vectors without a shuffle.

The vocabulary is fitted with the distributed aggregates of ``operators.terms`` and
is capped, so its terms fit the driver. Counting is MLlib's ``CountVectorizerModel``
on that vocabulary; TF-IDF scaling of the sparse vectors is one Arrow batch function,
because MLlib has neither the sublinear term frequency nor the +1 of this IDF.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.config import MAX_DF, MAX_FEATURES, MIN_DF
from folio.functions.arrays import native_ngrams
from folio.functions.text import clean_tokens, vectorizer_terms
from folio.operators.terms import count_rows, fit_vocabulary

SCALED_ROWS = 512  # vectors scaled at once in a task


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Raw text to vectoriser terms: cleaning chain, then n-grams."""

    minN = Param(Params._dummy(), "minN", "smallest n-gram", TypeConverters.toInt)
    maxN = Param(Params._dummy(), "maxN", "largest n-gram", TypeConverters.toInt)
    stem = Param(Params._dummy(), "stem", "whether to stem tokens", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="terms", minN=1, maxN=1, stem=False):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="text", outputCol="terms", minN=1, maxN=1, stem=False)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = F.coalesce(F.col(self.getInputCol()), F.lit(""))
        tokens = vectorizer_terms(clean_tokens(text, stem=self.getOrDefault(self.stem)))
        return dataset.withColumn(
            self.getOutputCol(),
            native_ngrams(tokens, self.getOrDefault(self.minN), self.getOrDefault(self.maxN)),
        )


class TfidfScaler(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Sparse counts to L2-normalised (1 + ln n) * idf weights."""

    idf = Param(Params._dummy(), "idf", "idf by term index", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="counts", outputCol="features", idf=None):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="counts", outputCol="features")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source, target = self.getInputCol(), self.getOutputCol()
        idf = dataset.sparkSession.sparkContext.broadcast(np.array(self.getOrDefault(self.idf)))
        kept = [f for f in dataset.schema.fields if f.name != source]
        schema = T.StructType(kept + [T.StructField(target, VectorUDT())])

        def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (whole.slice(at, SCALED_ROWS) for whole in batches for at in range(0, whole.num_rows, SCALED_ROWS)):
                columns = [batch.column(f.name) for f in kept]
                names = [f.name for f in kept] + [target]
                weights = _scale_vectors(batch.column(source), idf.value)
                yield pa.RecordBatch.from_arrays([*columns, weights], names=names)

        return dataset.select(*[f.name for f in kept], source).mapInArrow(scale, schema)


def _scale_vectors(vectors: pa.StructArray, idf: np.ndarray) -> pa.StructArray:
    """Scale the values of Arrow-encoded sparse vectors, document by document."""
    indices, values = vectors.field("indices"), vectors.field("values")
    index = indices.flatten().to_numpy(zero_copy_only=False)
    count = values.flatten().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(values.value_lengths().fill_null(0).to_numpy())])
    weight = (1.0 + np.log(count)) * idf[index]
    row = np.repeat(np.arange(len(vectors)), np.diff(offsets))
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(vectors)))
    scaled = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(weight / norm[row]))
    return pa.StructArray.from_arrays(
        [vectors.field("type"), vectors.field("size"), indices, scaled], names=["type", "size", "indices", "values"]
    )


class TextVectorizer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the vocabulary; the model is cleaner, counter and (for TF-IDF) scaler."""

    maxN = Param(Params._dummy(), "maxN", "largest n-gram", TypeConverters.toInt)
    tfidf = Param(Params._dummy(), "tfidf", "TF-IDF weights instead of counts", TypeConverters.toBoolean)
    minDF = Param(Params._dummy(), "minDF", "least documents per term", TypeConverters.toInt)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of documents", TypeConverters.toFloat)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary cap", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCol="text", outputCol="features", maxN=1, tfidf=False, minDF=MIN_DF, maxDF=MAX_DF,
        maxFeatures=MAX_FEATURES,
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(
            inputCol="text", outputCol="features", maxN=1, tfidf=False, minDF=MIN_DF, maxDF=MAX_DF,
            maxFeatures=MAX_FEATURES,
        )

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cleaner = TextCleaner(inputCol=self.getInputCol(), outputCol="terms", maxN=self.getOrDefault(self.maxN))
        words = TextCleaner(inputCol=self.getInputCol(), outputCol="words").transform(dataset.select(self.getInputCol()))
        vocabulary = fit_vocabulary(
            words.select("words"),
            count_rows(dataset),
            min_df=self.getOrDefault(self.minDF),
            max_df=self.getOrDefault(self.maxDF),
            max_features=self.getOrDefault(self.maxFeatures),
            ngram_range=(1, self.getOrDefault(self.maxN)),
        )
        kept = vocabulary.select("term", "idf").orderBy("term").collect()  # at most maxFeatures rows
        if not kept:
            raise ValueError("no term survives the document frequency limits")
        tfidf = self.getOrDefault(self.tfidf)
        counts = "counts" if tfidf else self.getOutputCol()
        stages = [
            cleaner,
            CountVectorizerModel.from_vocabulary([r["term"] for r in kept], inputCol="terms", outputCol=counts),
            DropColumns(columns=["terms"]),
        ]
        if tfidf:
            stages.append(
                TfidfScaler(inputCol=counts, outputCol=self.getOutputCol(), idf=[r["idf"] for r in kept])
            )
        return PipelineModel(stages)


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Leaves out helper columns."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault(self.columns))
