"""Word vectors go to the postings when their table is small, and a text's length goes instead of the text."""

import pytest

from folio.operators import vectors


def test_postings_and_texts_stay_where_they_are(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (2, "x"), (3, None), (4, "")], "id long, text string")
    postings = spark.createDataFrame([(1, "ab", 2), (1, "cd", 1), (2, "zz", 4), (3, "ab", 1), (4, "ab", 1)], "id long, term string, n long")
    words = spark.createDataFrame([("ab", [1.0, -2.0]), ("cd", [4.0, 1.0])], "word string, vec array<double>")
    done = vectors.mean_word_vector(docs, postings, words, 2)
    assert {r["id"]: r["vec"] for r in done.collect()} == {1: [2.0, -1.0], 2: [0.0, 0.0], 3: [1.0, -2.0], 4: [1.0, -2.0]}
    by_chars = vectors.mean_word_vector(docs, postings, words, 2, denominator="chars")
    got = {r["id"]: r["vec"] for r in by_chars.collect()}
    assert got[1] == pytest.approx([6 / 5, -3 / 5]) and got[2] == [0.0, 0.0]
    plan = by_chars._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [term" in plan and "ObjectHashAggregate" not in plan and "sum" in plan
