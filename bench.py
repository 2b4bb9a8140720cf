"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the cores; BENCH_QUERIES (names separated by commas) a subset.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from folio.plans import catalog
from folio.session import get_session

HEADLINE = (
    "preprocess clean_text html_fallback_parse parse_with_fallback parse_cms_article extract_links "
    "dedupe_url_accepted dedupe_url_claimed cap_per_class systematic_page_sample extraction_audit "
    "term_counts ngrams document_frequency tfidf top_tfidf_terms transform_with_vocabulary chi2_scores "
    "select_k_best mean_word_vector encode_fixed_length pool_tokens stratified_kfold random_split "
    "cv_summary token_stats token_density monthly_counts naive_bayes_predict cross_validate "
    "temporal_validation few_shot_prompt chat_messages vectorizer_model report_tables "
    "logistic_fit bow_logistic_fit linear_svc_fit embedding_classifier voting_fit"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # each table here is one file of one row group
            "folio.input.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query takes the start of the JVM and of the Python workers
    catalog.QUERIES["clean_text"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # every row and column is computed, none is kept
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
