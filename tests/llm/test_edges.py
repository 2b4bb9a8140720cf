"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from folio.llm import (
    decontamination,
    html_text,
    mixing,
    passages,
    quality,
    recurrent_lm,
    secret_scan,
    sharding,
    simhash,
    token_planes,
)
from folio.llm.queries import tokenizer_path

LONG = "alpha beta gamma delta " * 30_000
PLAIN = " ".join(f"word{i} and{i} other{i % 7}" for i in range(60))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHES = "id size source_size h k r key seed fp component word code start end other place text_hash copies __copy item".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, PLAIN, "en", "a", 10),
        (1, PLAIN, "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", "b", 4),
        (5, LONG, "en", "b", len(LONG)),
        (None, PLAIN + " end", "en", "b", 9),
        (7, PLAIN, "de", None, 10),
        (8, "é ü 漢字   x", "de", "é", 8),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PLAIN[:200]), (2, None), (3, ""), (None, "too short"), (1, PLAIN[:200])]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def pages(spark):
    page = "<html><body><article><p>One &amp; two</p></article></body></html>"
    rows = [(1, "http://a.b/c", page), (1, "http://a.b/c", page), (2, None, page), (3, "x", None), (None, "http://a.b/d", ""), (5, "", "<p>" * 20000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("id", "host", "row", "keys", "place")})


def operators(docs, benchmark, pages):
    return {
        "mixing": lambda: mixing.mix(docs),
        "repeat": lambda: mixing.repeat_rows(docs),
        "tokens": lambda: token_planes.encode_and_read(docs, tokenizer_path()),
        "simhash": lambda: simhash.near_duplicates(docs),
        "group": lambda: simhash.one_per_group(docs),
        "decontamination": lambda: decontamination.contaminations(docs, benchmark),
        "clean": lambda: decontamination.without_contaminated(docs, benchmark),
        "quality": lambda: quality.cascade(docs, measures=True),
        "keep": lambda: quality.keep_clean(docs),
        "html": lambda: html_text.extract(pages),
        "lm": lambda: recurrent_lm.score(docs),
        "sharding": lambda: sharding.assign_shards(docs),
        "passages": lambda: passages.shared_passages(docs),
        "secrets": lambda: secret_scan.digest(secret_scan.scan(docs)),
    }


NAMES = list(operators(None, None, None))
PER_ROW = {"mixing", "tokens", "simhash", "quality", "lm", "sharding", "secrets"}
EXPECTED = {"keep": 4, "html": 6}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, benchmark, pages, name):
    got = operators(docs, benchmark, pages)[name]().collect()
    if name in PER_ROW:
        assert len(got) == docs.count()
    if name in EXPECTED:
        assert len(got) == EXPECTED[name]
    if name == "lm":
        by_id = {r["id"]: r for r in got}
        assert by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1 and by_id[None]["held_out"]
        assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    if name == "simhash":
        by_id = {r["id"]: r for r in got}
        assert by_id[2]["fp"] == by_id[3]["fp"] == by_id[4]["fp"] == 0 and by_id[4]["component"] == 2
        assert by_id[7]["component"] == 1
    if name == "group":
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 5), (False, 8), (True, 0)]
    if name == "clean":
        assert {r["doc_id"] for r in got} == {2, 3, 4, 5, 8}
    if name == "passages":
        assert {(r["id"], r["other"]) for r in got} == {(7, None), (1, None)}
    if name in ("repeat", "group", "clean", "keep"):
        assert list(got[0].asDict()) == docs.columns
        assert all(r[c] == "clash" for r in got for c in CLASHES)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, benchmark, pages, name):
    none = operators(docs.limit(0), benchmark.limit(0), pages.limit(0))[name]()
    assert none.count() == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_tables(spark, docs, benchmark, tmp_path, number):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, step = corpus_pipeline.STAGES[number]
    out = step(spark, docs, str(tmp_path))
    if number < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
    assert out.count() > 0
    assert step(spark, docs.limit(0), str(tmp_path)).count() == 0
