import random
import zlib

import pytest

from folio.llm import sharding


def shards(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sharding.assign_shards(docs, **options).toPandas()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    rows = [(i, "x" * int(rng.lognormvariate(5, 1))) for i in range(4000)]
    texts = [f"copy {i} " + "y" * 200 for i in range(100)]
    return rows + [(10_000 + i, texts[i % 100]) for i in range(800)]


def test_bytes_are_near_equal_and_slots_have_no_gaps(spark, rows):
    got = shards(spark, rows)
    sums = got.groupby("shard")["size"].sum()
    assert len(got) == len(rows) and list(sums.index) == list(range(16))
    assert sums.max() / sums.mean() < 1.03 and sums.min() / sums.mean() > 0.97
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    texts = {i: t.encode() for i, t in rows}
    assert all(n == len(texts[i]) + 1 and crc == zlib.crc32(texts[i]) for i, n, crc in zip(got.id, got["size"], got.crc))


def test_equal_texts_share_a_shard(spark, rows):
    got = shards(spark, rows)
    copies = got[got.id >= 10_000]
    assert (copies.groupby("crc").shard.nunique() == 1).mean() > 0.95


def test_a_text_in_a_third_of_the_rows_is_cut(spark, rows):
    hot = [(50_000 + i, "hot " * 60) for i in range(2500)]
    got = shards(spark, rows + hot)
    sums = got.groupby("shard")["size"].sum()
    assert got[got.id >= 50_000].shard.nunique() > 3
    assert sums.max() / sums.mean() < 1.05 and sums.min() / sums.mean() > 0.95


def test_reruns_agree(spark, rows):
    key = lambda got: set(zip(got.id, got.shard, got.slot))
    assert key(shards(spark, rows)) == key(shards(spark, rows[::-1]))


def test_few_and_odd_rows(spark):
    got = shards(spark, [(1, None), (2, ""), (None, "a")], n_shards=4)
    assert sorted(got["size"]) == [1, 1, 2] and set(got.shard) <= set(range(4))
