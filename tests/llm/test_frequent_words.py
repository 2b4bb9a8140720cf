"""The words that are counted in place are those of all training documents, not of a sample."""

from collections import Counter

from folio.llm import recurrent_lm


def test_frequent_words_have_the_largest_exact_counts(spark):
    # 9,000 documents: word wK is in those whose number is at least K, so counts of neighbours differ by one
    rows = [(i, i % 10 == 0, " ".join(f"W{k}" for k in range(8990, min(i, 8999) + 1)) + f" common{i % 7}") for i in range(9000)]
    rows += [(9000 + i, False, f"\t common{i % 3} {'x' * 65} " * 2) for i in range(5)]
    count = Counter(w for _, held, t in rows if not held for w in t.encode().lower().split() if len(w) <= 64)
    want = sorted(count, key=lambda w: (-count[w], w))
    df = spark.createDataFrame(rows, "key long, held_out boolean, text string")
    assert recurrent_lm._frequent(df, 12) == want[:12]
    assert recurrent_lm._frequent(df, 1000) == want


def test_words_of_the_least_count_are_chosen_in_word_order(spark):
    rows = [(i, False, f"often twice{i // 2 % 40} once{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "key long, held_out boolean, text string")
    twice = sorted(f"twice{i}".encode() for i in range(40))
    assert recurrent_lm._frequent_counts(df, 7) == [(b"often", 80), *((w, 2) for w in twice[:6])]
    assert len(recurrent_lm._frequent(df, 100)) == 100
    assert recurrent_lm._frequent(df.limit(0), 5) == []
