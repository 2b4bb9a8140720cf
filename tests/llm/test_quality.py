import random
import re
from collections import Counter

import pytest

from folio.llm import quality


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    m = dict(
        n_words=len(words),
        word_chars=sum(map(len, words)),
        n_symbols=len(re.findall(r"[#*$%&|<>]", text)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=len(covered),
    )
    n = len(words)
    bad = (
        n < 10
        or 100 * len(covered) > 20 * n
        or 10 * m["n_symbols"] > n
        or 2 * m["n_dup_lines"] > len(lines)
        or 10 * sum(a == b for a, b in zip(words, words[1:])) > 3 * n
        or 10 * len(re.findall("[A-Z]", text)) > 3 * m["word_chars"]
        or not 2 * n <= m["word_chars"] <= 14 * n
        or (n >= 50 and 4 * max(Counter(words).values()) > n)
    )
    return m | {"kept": not bad}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, "a\n\na\n a\na"), (3, "x " * 9 + "y"), (4, "a b c d e a b c d e f")]
    for i in range(5, 200):
        pool = [f"{c}{j}" for j in range(rng.choice([2, 10, 300])) for c in rng.choice([["w"], ["É", "ab#"], ["LOUD", "q"]])]
        lines = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        rows.append((i, rng.choice(["\n", "\t", "\n\n"]).join(lines + rng.choices(lines, k=rng.randint(0, 2)))))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_measures_and_verdict(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.cascade(docs, measures=True).collect():
        want = by_hand(texts[r["id"]])
        assert {k: r[k] for k in want} == want, texts[r["id"]]


def test_the_order_changes_no_verdict(docs):
    names = [n for n, _ in quality.RULES]
    verdicts = [{(r["id"], r["kept"]) for r in quality.cascade(docs, order=o).collect()} for o in (names, names[::-1])]
    assert verdicts[0] == verdicts[1]
    assert {r["doc_id"] for r in quality.keep_clean(docs).collect()} == {i for i, kept in verdicts[0] if kept}


def test_cheap_rules_that_reject_come_first(spark):
    import time

    rules = (
        ("slow", lambda t: time.sleep(0.002) or b"z" in t.data),
        ("never", lambda t: False),
        ("quick", lambda t: b"z" in t.data),
    )
    docs = spark.createDataFrame([(i, "z" if i % 2 else "a") for i in range(100)], "doc_id long, text string")
    assert quality.estimate_order(docs, rules)[0] == "quick" and quality.estimate_order(docs, rules)[2] == "never"
    first = {r["rejected_by"] for r in quality.cascade(docs, rules).collect()}
    assert first == {None, "quick"}


def test_a_large_vocabulary_is_counted_exactly():
    words = [f"w{i}" for i in range(20_000)]
    text = quality.Text(" ".join(words + words[100:105] + ["end"]).encode())
    assert text.n_repeat_words == 10
