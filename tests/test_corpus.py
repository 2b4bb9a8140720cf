import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folio.evaluation import descriptive, metrics
from folio.operators import dedupe, splits
from folio.operators.ranking import hash_rank, staged_rank

ARTICLE = "id long, category string, url string, body string"
LONG, SHORT = "x" * 150, "x" * 149


def test_ranks_match_brute_force_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(7)
    want = {}
    for key in {r[1] for r in rows}:
        for rank, row in enumerate(sorted((r[2], r[0]) for r in rows if r[1] == key), 1):
            want[row[1]] = rank
    got = {r.id: r["rank"] for r in staged_rank(df, ["g"], ["v", "id"]).collect()}
    assert got == want
    whole = {r.id: r["rank"] for r in staged_rank(df, [], ["v", "id"]).collect()}
    assert [i for i, _ in sorted(whole.items(), key=lambda x: x[1])] == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]

    digest = F.md5(F.col("id").cast("string"))
    hashed = hash_rank(df, ["g"], digest).withColumn("d", digest).collect()
    assert len(hashed) == len(rows)
    for key in {r[1] for r in rows}:
        members = sorted((r.d, r["rank"]) for r in hashed if r.g == key)
        assert [rank for _, rank in members] == list(range(1, len(members) + 1))


def test_url_rules_differ_on_short_first_copies(spark):
    rows = [(1, "b", "u", SHORT), (2, "b", "u", LONG), (3, "a", "u", LONG), (4, "a", "", LONG), (5, "b", "", LONG)]
    df = spark.createDataFrame(rows, ARTICLE)
    accepted = dedupe.dedupe_url_accepted(dedupe.min_body_filter(df), ["b", "a"])
    assert sorted(r.id for r in accepted.collect()) == [2, 4, 5]
    assert sorted(r.id for r in dedupe.dedupe_url_claimed(df).collect()) == [3, 4, 5]
    assert sorted(r.id for r in dedupe.drop_duplicate_urls(df).collect()) == [1, 4]
    audit = {r.category: (r.accepted, r.short, r.duplicate) for r in dedupe.extraction_audit(df, ["b", "a"]).collect()}
    assert audit == {"b": (2, 1, 0), "a": (1, 0, 1)}


def test_cap_and_guard(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "b", "", "") for i in range(100)], ARTICLE)
    capped = dedupe.cap_per_class(df, 5).collect()
    assert sorted(r.id for r in capped) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 12]
    assert dedupe.require_min_rows(df, 100) is df
    with pytest.raises(ValueError):
        dedupe.require_min_rows(df, 101)


@pytest.mark.parametrize("total,target", [(7, 100), (15, 1), (1000, 100), (1000, 10_000), (100, 31)])
def test_page_sample_matches_the_page_plan(spark, total, target):
    max_page = max(1, total // 15)
    needed = min(max(1, -(-target // 15)), max_page)
    wanted = list(range(1, max_page + 1)) if needed >= max_page else list(range(1, max_page + 1, max(1, max_page // needed)))[:needed]
    df = spark.range(total).withColumn("s", F.lit("x"))
    got = {r.page for r in dedupe.systematic_page_sample(df, ["s"], ["id"], target).collect()}
    assert got == set(wanted)


def test_block_sample_pages(spark):
    pages = [p for b in range(3) for p in range(b * 25 + 1, b * 25 + 6)]
    df = spark.range(1, 200).select("id", dedupe.in_sampled_block(F.col("id"), 5, 20, 3).alias("k"))
    assert [r.id for r in df.filter("k").orderBy("id").collect()] == pages


def test_folds_are_stratified_and_partition_the_ids(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(101)] + [(1000, "single")]
    folds = splits.stratified_kfold(spark.createDataFrame(rows, "id long, label string"), 5).collect()
    assert sorted(r.id for r in folds) == sorted(r[0] for r in rows)
    for label in ("a", "b"):
        sizes = [sum(r.label == label and r.fold == f for r in folds) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    halves = splits.random_split(spark.range(101)).collect()
    assert sum(r.split == "train" for r in halves) == 50


def test_temporal_split_clamps_month_ends(spark):
    rows = [(1, dt.datetime(2024, 5, 31, 12)), (2, dt.datetime(2024, 2, 29, 12)), (3, dt.datetime(2024, 2, 29, 13)), (4, None)]
    got = splits.temporal_split(spark.createDataFrame(rows, "id int, date timestamp_ntz")).collect()
    assert {r.id: r.split for r in got} == {1: "test", 2: "train", 3: "test"}


def test_batches(spark):
    sizes = splits.assign_batches(spark.range(70), [], ["id"]).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in sizes} == {0: 32, 1: 32, 2: 6}


def test_metrics_against_hand_counts(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("b", "z")]
    df = spark.createDataFrame(rows, "y string, p string")
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert (report["b"].precision, report["b"].recall, report["b"].f1) == (1 / 3, 0.5, 0.4)
    assert (report["z"].precision, report["z"].recall, report["c"].f1) == (0.0, 0.0, 0.0)
    one = metrics.summary_scores(df).first()
    assert one.accuracy == 0.4 and one["size"] == 5
    assert one.macro_f1 == pytest.approx((2 / 3 + 0.4) / 4)
    assert one.weighted_f1 == pytest.approx((2 * 2 / 3 + 2 * 0.4) / 5)
    matrix = metrics.confusion_normalized(df, ["a", "b", "c", "z"]).collect()
    assert all(sum(r[1:]) == pytest.approx(1.0) for r in matrix)
    auc = {r["class"]: r.auc for r in metrics.auc_hard(df).collect()}
    assert auc["a"] == pytest.approx((0.5 + 1.0) / 2)


def test_cv_confusion_keeps_absent_classes(spark):
    df = spark.createDataFrame([("m", 0, "a", "a"), ("m", 1, "b", "a")], "model string, fold int, y string, p string")
    got = {r.y: (r.pred_a, r.pred_b, r.pred_c) for r in metrics.cv_confusion_mean(df, ["a", "b", "c"], 2).collect()}
    assert got == {"a": (0.5, 0.0, 0.0), "b": (0.5, 0.0, 0.0), "c": (0.0, 0.0, 0.0)}


def test_best_model_first_wins(spark):
    rows = [("x", 0.5, 2), ("y", 0.9, 3), ("z", 0.9, 4)]
    df = spark.createDataFrame(rows, "model string, macro_f1_mean double, ord int")
    assert metrics.best_model(df).first().model == "y"


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([("a", i % 17) for i in range(200)] + [("one", 3)], "category string, n_tokens int")
    rows = descriptive.token_density(df).orderBy("idx").collect()
    assert {r.category for r in rows} == {"a"} and len(rows) == 200
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(rows, rows[1:]))
    assert area == pytest.approx(1.0, abs=0.01)


def test_date_range_without_dates(spark):
    df = spark.createDataFrame([("a", None)], "category string, date timestamp_ntz")
    assert {tuple(r) for r in descriptive.date_range(df).collect()} == {("a", "?", "?"), ("*", "?", "?")}


def test_auc_of_independent_decisions(spark):
    """One machine per class: rows with no class or two; brute force by the ROC curve of 0/1 scores."""
    import random

    classes = ["a", "b", "c"]
    rnd = random.Random(2)
    rows = [(rnd.choice([0, 1]), rnd.choice(classes), [rnd.randint(0, 1) for _ in classes]) for _ in range(300)]
    rows += [(0, "a", [0, 0, 0]), (0, "b", [1, 1, 0]), (1, "c", [0, 0, 0])]
    df = spark.createDataFrame(rows, "fold int, y string, decided array<int>")
    got = {(r["fold"], r["class"]): r["auc"] for r in metrics.auc_binary(df, classes, ["fold"]).collect()}

    def roc_area(truth, score):
        pos = [s for t, s in zip(truth, score) if t]
        neg = [s for t, s in zip(truth, score) if not t]
        # probability that a positive outranks a negative, ties counted half: the area under the ROC curve
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))

    for fold in (0, 1):
        part = [r for r in rows if r[0] == fold]
        for c, name in enumerate(classes):
            want = roc_area([r[1] == name for r in part], [r[2][c] for r in part])
            assert abs(got[(fold, name)] - want) < 1e-12
