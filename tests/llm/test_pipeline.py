"""The pipeline against a version by hand, stage after stage."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontamination import overlaps
from test_mixing import water_fill
from test_quality import by_hand as quality_by_hand
from test_simhash import by_hand as fingerprint_by_hand
from test_simhash import classes
from tokenizers import Tokenizer

from folio.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(900)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (15, 25, 40)]
    rows = []
    for i in range(160):
        words = text(rng.randint(5, 250))
        if i % 9 == 0:
            words += rng.choice(items)
        if i % 11 == 0:
            words = words[:1] * 60
        if i % 7 == 0 and rows:
            words = rng.choice(rows)[1].split()
            words[len(words) // 2 : len(words) // 2] = ["extra"] * (i % 2)
        rows.append((i, " ".join(words), "en", f"s{i % 4}", len(" ".join(words))))
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    bench = [(i, " ".join(b)) for i, b in enumerate(items)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {r[0]: r for r in rows}, [b for _, b in bench]


def test_stages_by_hand(spark, sf_dir):
    folder, rows, items = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5

    kept = {i for i, r in rows.items() if quality_by_hand(r[1])["kept"]}
    docs = steps["quality rules"](spark, docs, folder)
    assert {r["doc_id"] for r in docs.collect()} == kept and docs.columns == columns and len(kept) < len(rows)

    ids = sorted(kept)
    fps = [fingerprint_by_hand(rows[i][1]) for i in ids]
    first = {ids[j] for j in classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)}
    docs = steps["simhash near-dedup"](spark, docs, folder)
    assert {r["doc_id"] for r in docs.collect()} == first and len(first) < len(kept)

    clean = {i for i in first if not any(overlaps(rows[i][1], b) for b in items)}
    docs = steps["benchmark decontamination"](spark, docs, folder)
    assert {r["doc_id"] for r in docs.collect()} == clean and len(clean) < len(first)

    words = defaultdict(int)
    for i in clean:
        words[rows[i][3]] += len(rows[i][1].split())
    order = sorted(words)
    wanted = dict(zip(order, water_fill([words[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    mixed = steps["mixing sources"](spark, docs, folder)
    count = Counter(r["doc_id"] for r in mixed.collect())
    taken = defaultdict(int)
    for i, n in count.items():
        assert i in clean and n <= 3
        taken[rows[i][3]] += n * len(rows[i][1].split())
    assert all(taken[s] == pytest.approx(wanted[s], rel=0.03) for s in order)

    encoded = sorted(steps["token output"](spark, mixed, folder).collect(), key=lambda r: r["start"])
    tokenizer, start = Tokenizer.from_file(tokenizer_path()), 0
    assert [r["doc_id"] for r in encoded] == sorted(count.elements())
    for r in encoded:
        found = tokenizer.encode(rows[r["doc_id"]][1], add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"]) == (start, len(found))
        assert r["ids_crc32"] == zlib.crc32(np.array(found, "<u4").tobytes())
        start += len(found)

    # run() is the stages one after the other
    again = corpus_pipeline.run(spark, folder).select(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    assert (again["n"], again["rows"]) == (start, len(encoded))
