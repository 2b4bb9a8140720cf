"""The physical plans the operators are meant to get."""

import pytest

from folio.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedupe_url_accepted", "dedupe_url_claimed", "drop_duplicate_urls", "dedupe_slug_last"])
def test_keep_first_is_pruned_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize(
    "name", ["tfidf", "chi2_scores", "temporal_validation", "naive_bayes_predict", "cv_confusion_mean", "token_density", "few_shot_prompt"]
)
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_postings_need_no_shuffle_of_their_own(spark):
    assert "Exchange" not in plan(spark, "term_counts")


def test_weights_need_no_shuffle_of_postings(spark):
    for name in ("tfidf", "transform_with_vocabulary"):
        assert "Exchange" not in plan(spark, name)


def test_vocabulary_is_not_sorted_in_one_task(spark):
    text = plan(spark, "top_vocabulary")
    assert "TakeOrdered" not in text and "SinglePartition" not in text


def test_only_flags_travel_for_claimed_urls(spark):
    text = plan(spark, "dedupe_url_claimed")
    window = text[text.index("WindowGroupLimit") :]
    assert "body" not in window.split("Scan parquet")[0]


def test_report_reads_staged_inputs(spark):
    assert "documents.parquet" not in plan(spark, "report_tables")


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan(spark, "stratified_kfold")
    assert "ReadSchema: struct<doc_id:bigint,text:string" in plan(spark, "clean_text")
