"""Dense vectors: word averages, pooling of hidden states, encoders."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators import vectors
from folio.plans.inputs import ARTICLES_SQL, POSTINGS_SQL, VOCABULARY_SQL, articles, documents, labels, staged_postings
from folio.plans.registry import query
from folio.plans.source_queries import WORD_DIM, WORD_VECTORS_SQL, word_vectors
from folio.functions.text import embed_text


def by_dimension(df, *keys):
    return df.select(*keys, F.posexplode("vec").alias("dim", "x")).select(
        *keys, "dim", F.round("x", 6).alias("value")
    )


@query(
    "mean_word_vector",
    f"""WITH {POSTINGS_SQL}, {VOCABULARY_SQL}, {WORD_VECTORS_SQL},
means AS (
  SELECT id, i, sum(n * x) / sum(n) AS value FROM postings JOIN word_vectors ON term = word GROUP BY id, i)
SELECT doc_id AS id, CAST(d.i AS INTEGER) AS dim, round(coalesce(value, 0), 6) AS value
FROM documents CROSS JOIN (SELECT unnest(range({WORD_DIM})) AS i) d
LEFT JOIN means m ON m.id = doc_id AND m.i = d.i""",
)
def mean_word_vector(spark, sf):
    rows = staged_postings(spark, sf)
    words = word_vectors(spark, sf, rows)
    done = vectors.mean_word_vector(labels(spark, sf).select("id"), rows, words, WORD_DIM)
    return by_dimension(done, "id")


HIDDEN_SQL = """hidden AS (
  SELECT vec_id // 13 // 10 AS doc, CAST(vec_id // 13 % 10 AS INTEGER) AS pos, CAST(vec_id % 13 AS INTEGER) AS layer,
         embedding AS vec FROM embeddings)"""


def hidden_states(spark, sf):
    """Every embedding as one layer of one token: 13 layers a token, 10 tokens a document."""
    vec = F.col("vec_id")
    token = F.floor(vec / 13)
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.floor(token / 10).alias("doc"),
        (token % 10).cast("int").alias("pos"),
        (vec % 13).cast("int").alias("layer"),
        F.col("embedding").alias("vec"),
    )


@query(
    "pool_layers",
    f"""WITH {HIDDEN_SQL},
upper_layers AS (SELECT * FROM hidden WHERE layer >= 9),
joined AS (SELECT doc, pos, flatten(list(vec ORDER BY layer DESC)) AS vec FROM upper_layers GROUP BY doc, pos),
concat AS (SELECT doc, pos, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec)::DOUBLE AS value FROM joined),
dims AS (SELECT doc, pos, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec)::DOUBLE AS value FROM upper_layers)
SELECT 'concat' AS kind, doc, pos, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM concat
UNION ALL SELECT 'sum', doc, pos, CAST(dim AS INTEGER), round(sum(value), 6) FROM dims GROUP BY doc, pos, dim""",
)
def pool_layers(spark, sf):
    """Both ways to make a token vector of the last four layers."""
    hidden = hidden_states(spark, sf)
    both = [
        (F.lit("concat"), vectors.concat_layers(hidden)),
        (F.lit("sum"), vectors.sum_layers(hidden)),
    ]
    parts = [
        df.select(kind.alias("kind"), "doc", "pos", F.col("vec").cast("array<double>").alias("vec")) for kind, df in both
    ]
    return by_dimension(parts[0].unionByName(parts[1]), "kind", "doc", "pos")


@query(
    "pool_tokens",
    f"""WITH {HIDDEN_SQL},
dims AS (SELECT doc, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec)::DOUBLE AS value FROM hidden WHERE layer = 11)
SELECT doc, CAST(dim AS INTEGER) AS dim, round(avg(value), 6) AS value FROM dims GROUP BY doc, dim""",
)
def pool_tokens(spark, sf):
    return by_dimension(vectors.pool_tokens(hidden_states(spark, sf)), "doc")


@query(
    "combine_subwords",
    f"""WITH {HIDDEN_SQL},
dims AS (
  SELECT doc, CAST(pos // 3 AS INTEGER) AS word_id, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec)::DOUBLE AS value
  FROM hidden)
SELECT 'mean' AS kind, doc, word_id, CAST(dim AS INTEGER) AS dim, round(avg(value), 6) AS value
FROM dims GROUP BY doc, word_id, dim
UNION ALL SELECT 'sum', doc, word_id, CAST(dim AS INTEGER), round(sum(value), 6) FROM dims GROUP BY doc, word_id, dim""",
)
def combine_subwords(spark, sf):
    """Three consecutive token positions make a word."""
    pieces = hidden_states(spark, sf).withColumn("word_id", F.floor(F.col("pos") / 3).cast("int"))
    parts = [
        vectors.combine_subwords(pieces, how=how).withColumn("kind", F.lit(how)) for how in ("mean", "sum")
    ]
    return by_dimension(parts[0].unionByName(parts[1]), "kind", "doc", "word_id")


@query(
    "mean_word_vector_by_chars",
    f"""WITH {POSTINGS_SQL}, {VOCABULARY_SQL}, {WORD_VECTORS_SQL},
sums AS (SELECT id, i, sum(n * x) AS value FROM postings JOIN word_vectors ON term = word GROUP BY id, i)
SELECT doc_id AS id, CAST(d.i AS INTEGER) AS dim, round(coalesce(value / length(text), 0), 6) AS value
FROM documents CROSS JOIN (SELECT unnest(range({WORD_DIM})) AS i) d
LEFT JOIN sums m ON m.id = doc_id AND m.i = d.i""",
)
def mean_word_vector_by_chars(spark, sf):
    """The older average: the sum over known tokens divided by the characters of the text."""
    rows = staged_postings(spark, sf)
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), "text")
    done = vectors.mean_word_vector(docs, rows, word_vectors(spark, sf, rows), WORD_DIM, denominator="chars")
    return by_dimension(done, "id")


@query(
    "embed_batch",
    f"""WITH {ARTICLES_SQL},
texts AS (
  SELECT id, trim(coalesce(title, '') || '. ' || coalesce(subtitle, '') || '. ' || left(coalesce(body, ''), 200)) AS text
  FROM articles),
codes AS (
  SELECT id, CAST('0x' || left(md5(token), 8) AS BIGINT) AS code
  FROM (SELECT id, unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS token FROM texts)),
sums AS (
  SELECT id, code % 16 AS dim, sum(CASE WHEN code & 65536 > 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS x FROM codes GROUP BY ALL),
norms AS (SELECT id, sqrt(sum(x * x)) AS norm FROM sums GROUP BY id)
SELECT doc_id AS id, CAST(d.dim AS INTEGER) AS dim,
       round(coalesce(x, 0) / CASE WHEN coalesce(norm, 0) = 0 THEN 1 ELSE norm END, 6) AS value
FROM documents CROSS JOIN (SELECT unnest(range(16)) AS dim) d
LEFT JOIN sums s ON s.id = doc_id AND s.dim = d.dim LEFT JOIN norms n ON n.id = doc_id""",
)
def embed_batch(spark, sf):
    """Embeddings of title, subtitle and the start of the body by the stand-in encoder."""
    text = embed_text(F.col("title"), F.col("subtitle"), F.col("body"))
    rows = articles(spark, sf).select("id", text.alias("text"))
    done = vectors.embed_batch(rows, "text", vectors.hashing_encoder(), element=T.DoubleType())
    return by_dimension(done.withColumnRenamed("embedding", "vec"), "id")
