import random

import pytest

from folio.llm import decontamination


def overlaps(doc, item, overlap=20, agree=0.8):
    """Whether some aligned window of the item agrees with the document in enough words."""
    norm = lambda text: [w.lower().strip(".,;:!?") for w in text.split()]
    d, b = norm(doc), norm(item)
    n = min(overlap, len(b))
    return any(
        sum(x == y for x, y in zip(d[i : i + n], b[j : j + n])) >= agree * n - 1e-9
        for j in range(len(b) - n + 1)
        for i in range(len(d) - n + 1)
    )


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (8, 9, 12, 15, 30, 45, 59)]
    docs = []
    for d in range(120):
        words = text(rng.randint(0, 200))
        if d % 3:
            item = list(rng.choice(items))
            for _ in range(d % 6):  # changed words
                item[rng.randrange(len(item))] = "changed"
            if d % 4 == 0:
                item = item[: rng.randint(4, len(item))]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "." if d % 5 == 0 else w for w in item]
        docs.append((d, " ".join(words)))
    items = [(i, " ".join(b)) for i, b in enumerate(items)]
    return docs, items


def test_matches_brute_force(spark, tables):
    docs, items = tables
    found = decontamination.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r["id"], r["item"]) for r in found}
    want = {(d, b) for d, text in docs for b, item in items if overlaps(text, item)}
    assert got <= want
    # a mask can miss an overlap whose changes lie badly, and no other
    assert len(want) > 40 and len(want - got) <= 0.05 * len(want)
    words = {d: t.split() for d, t in docs}
    assert all(0 <= r["start"] < r["end"] <= len(words[r["id"]]) for r in found)


def test_every_exact_item_is_found_and_clean_documents_stay(spark, tables):
    _, items = tables
    docs = [(i, f"before {item} after") for i, item in items] + [(100 + i, " ".join(f"own{j}" for j in range(80))) for i in range(5)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.without_contaminated(frame, bench)
    assert {r["doc_id"] for r in kept.collect()} == {100 + i for i in range(5)}
