"""Stems of token arrays: each distinct word of a batch is worked out once, with the result of the column expression."""

import random

from pyspark.sql import functions as F

from folio.functions import stem


def test_token_arrays_have_the_stems_of_the_column_expression(spark):
    rnd = random.Random(3)
    lists = [stem.PRONOUNS, stem.STANDARD, stem.WITH_IC, stem.Y_VERBS, stem.GU_VERBS, stem.VERBS, stem.RESIDUAL]
    ends = " ".join([*lists, "logía ución encia amente ativamente mente idad iva uyendo guemos"]).split()
    letters = "bcdfglmnprstguaeiouáéíóúüñ"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 7))) + rnd.choice(ends) * rnd.randint(0, 1) + rnd.choice(ends) for _ in range(3000)]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    got = rows.select(stem.stem_es(F.col("word")).alias("a"), stem.stem_tokens(F.array("word", "word")).alias("b")).collect()
    assert [r["b"] for r in got] == [[r["a"]] * 2 for r in got]


def test_a_repeated_word_is_stemmed_once(spark):
    stem.stem_word.cache_clear()
    import pyarrow as pa

    tokens = pa.array([["corriendo", "casas"] * 500, None, [], ["casas", None]], pa.list_(pa.string()))
    got = stem.stem_tokens.func(tokens).to_pylist()
    assert got == [["corr", "cas"] * 500, None, [], ["cas", None]]
    assert stem.stem_word.cache_info().misses == 2
