import random

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import passages


def best_chain(x, y, k=8, cost=0.05):
    score = []
    for i in range(len(x)):
        before = [score[j] - cost * (x[i] - x[j] + y[i] - y[j] - 2 * k) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        score.append(k + max([0.0, *before]))
    return max(score)


@pytest.mark.parametrize("seed", range(20))
def test_chains_are_the_best_ones(seed):
    rng = random.Random(seed)
    x = np.array(sorted(rng.sample(range(400), 25)))
    y = np.array([rng.randint(0, 400) for _ in x])
    found = passages.chains(x, y)
    assert sorted(i for c in found for i in c) == list(range(len(x)))
    top = found[0]
    assert all(np.diff(x[top]) > 0) and all(np.diff(y[top]) > 0)
    gaps = sum(x[b] - x[a] + y[b] - y[a] - 16 for a, b in zip(top, top[1:]))
    assert 8 * len(top) - 0.05 * gaps == pytest.approx(best_chain(x, y))


def test_alignment_over_changed_and_missing_words():
    rng = np.random.default_rng(1)
    other = rng.integers(0, 1000, 120)
    own = np.r_[rng.integers(5000, 6000, 10), other[:50], [7777], other[51:80], other[84:], rng.integers(5000, 6000, 10)]
    x, y = np.array([10, 62, 95]), np.array([0, 52, 89])
    [(start, end, other_start, other_end, identity)] = passages.align(own, other, x, y)
    assert (start, end, other_start, other_end) == (10, 126, 0, 120) and identity == pytest.approx(115 / 120)
    # two passages far apart in one chain are two passages
    far = np.r_[own[:60], rng.integers(8000, 9000, 70), own[60:]]
    assert [p[:2] for p in passages.align(far, other, np.array([10, 40, 132, 165]), np.array([0, 30, 52, 89]))] == [(10, 60), (131, 196)]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [text(n) for n in (49, 51, 60, 90)]
    hot = text(70)
    rows = []
    for d in range(150):
        words = text(rng.randint(0, 150))
        planted = []
        if d % 3 == 0:
            planted.append(list(hot))
        if d % 5 == 0:
            planted.append(list(shared[d % 4]))
        if d % 7 == 0:
            fuzzy = list(shared[3])
            for i in (20, 45, 70):
                fuzzy[i] = "other"
            planted.append(fuzzy)
        for p in planted:
            at = rng.choice([0, len(words)])
            words[at:at] = p
        rows.append((d, " ".join(words)))
    return rows


def covered(rows, least):
    """Per document the words inside runs of ``least`` words that a document of smaller id holds."""
    seen, out = {}, {}
    for d, text in sorted(rows):
        words = text.split()
        runs = [tuple(words[i : i + least]) for i in range(len(words) - least + 1)]
        out[d] = {j for i, r in enumerate(runs) if r in seen for j in range(i, i + least)}
        for r in runs:
            seen.setdefault(r, d)
    return out


def test_all_exact_passages_are_found_and_nothing_else(spark, docs):
    found = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    own = {d: set() for d, _ in docs}
    words = dict((d, t.split()) for d, t in docs)
    for r in found:
        assert r["other"] < r["id"] and r["identity"] >= 0.8
        own[r["id"]] |= set(range(r["start"], r["end"]))
    for d, must in covered(docs, 50).items():
        assert must <= own[d]
    # of what is given, most words lie in runs of eight that occur earlier: the rest are changed words between them
    may = covered(docs, 8)
    for d in own:
        assert len(own[d] - may[d]) <= 0.2 * len(own[d])
        assert not own[d] or len(own[d]) >= 50
    assert sum(1 for d in own if own[d]) > 50 and all(words[d] for d in own if own[d])


def test_passages_with_changed_words_are_found(spark):
    """Planted passages of 80 to 95 % identity, which brute force along the planted diagonal confirms."""
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, planted = [], {}
    for length in (55, 80, 120):
        for percent in (5, 10, 15, 20):
            for _ in range(25):
                source = text(length)
                copy = list(source)
                for i in rng.sample(range(length), length * percent // 100):
                    copy[i] = "changed" + str(i)
                assert sum(a == b for a, b in zip(source, copy)) >= 0.8 * length
                d, at = len(rows), rng.randint(0, 80)
                rows.append((d, " ".join(text(40) + source + text(40))))
                rows.append((d + 1, " ".join(text(at) + copy + text(40))))
                planted[d + 1] = (length, percent, at)
    hit = {}
    for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["id"] in planted and r["other"] == r["id"] - 1 and r["identity"] >= 0.8
        length, _, at = planted[r["id"]]
        hit[r["id"]] = hit.get(r["id"], 0) + min(r["end"], at + length) - max(r["start"], at)
    recall = {
        (n, p): sum(hit.get(d, 0) >= 0.7 * n for d, c in planted.items() if c[:2] == (n, p)) / 25 for n in (55, 80, 120) for p in (5, 10, 15, 20)
    }
    print(recall)
    assert recall[80, 10] >= 0.95 and recall[120, 15] >= 0.9 and recall[55, 10] >= 0.8, recall


def plain_align(ours, theirs, x, y, k=8):
    """The alignment of one chain, seed by seed."""

    def reach(a, b):
        best = score = same = 0
        found = (0, 0)
        for n, (p, q) in enumerate(zip(a, b)):
            score, same = (score + 1, same + 1) if p == q else (score - 2, same)
            if score > best:
                best, found = score, (n + 1, same)
        return found

    matched, cuts = [0], [0]
    for i in range(1, len(x)):
        a, b = ours[x[i - 1] : x[i]], theirs[y[i - 1] : y[i]]
        matched.append(sum(p == q for p, q in zip(a, b)) if len(a) == len(b) else passages._gap_matches(np.array(a), np.array(b)))
        if 2 * (matched[-1] - k) < max(len(a), len(b)) - k and max(len(a), len(b)) > 2 * k:
            cuts.append(i)
    found = []
    for first, after in zip(cuts, [*cuts[1:], len(x)]):
        left, left_same = reach(ours[: x[first]][::-1], theirs[: y[first]][::-1])
        right, right_same = reach(ours[x[after - 1] + k :], theirs[y[after - 1] + k :])
        start, end, other, other_end = x[first] - left, x[after - 1] + k + right, y[first] - left, y[after - 1] + k + right
        same = k + sum(matched[first + 1 : after]) + left_same + right_same
        found.append((start, end, other, other_end, same / max(end - start, other_end - other)))
    return found


@pytest.mark.parametrize("cells", [1, 64, 1 << 21])
def test_chains_aligned_together_are_those_aligned_alone(monkeypatch, cells):
    monkeypatch.setattr(passages, "CELLS", cells)
    rng = np.random.default_rng(9)
    words, bounds, sizes, xs, ys, expected, at = [], [], [], [], [], [], 0
    for number in range(200):
        theirs = rng.integers(0, 20 if number % 3 else 500, rng.integers(8, 200))
        ours = np.delete(theirs, rng.integers(0, len(theirs), rng.integers(0, 5)))
        ours[rng.integers(0, len(ours), rng.integers(0, 20))] = 7
        if len(ours) < 8:
            continue
        n = min(len(ours) - 7, 1 + number % 5)
        x = np.sort(rng.choice(len(ours) - 7, n, replace=False))
        y = np.sort(rng.choice(len(theirs) - 7, n, replace=False)) if number % 2 else x
        expected += [(len(sizes), *p) for p in plain_align(ours.tolist(), theirs.tolist(), x.tolist(), y.tolist())]
        bounds.append((at, at + len(ours), at + len(ours) + len(theirs)))
        words += [ours, theirs]
        sizes.append(n)
        xs.append(x + at)
        ys.append(y + at + len(ours))
        at = bounds[-1][2]
    begin, middle, end = np.array(bounds).T
    of, *places, identity = passages.align_chains(
        np.concatenate(words), (begin, middle), (middle, end), np.array(sizes), np.concatenate(xs), np.concatenate(ys)
    )
    start, stop, other, other_stop = places
    got = zip(of, start - begin[of], stop - begin[of], other - middle[of], other_stop - middle[of], identity)
    assert [tuple(g) for g in got] == expected


def test_groups_of_a_sorted_column_stay_whole_across_batches():
    values = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    rows = pa.record_batch({"v": values})
    for cuts in ([], [1], [3, 5], [4, 5, 6], [2, 2, 8], list(range(1, 11))):
        batches = [rows.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, len(values)])]
        tables = [t.column(0).to_pylist() for t in passages._whole(iter(batches), 0)]
        assert sum(tables, []) == values and all(a[-1] < b[0] for a, b in zip(tables, tables[1:]))


def test_passages_count_with_those_that_touch_them():
    of = np.array([1, 1, 1, 2, 2, 3])
    start, end = np.array([0, 10, 60, 20, 75, 3]), np.array([40, 30, 75, 70, 90, 52])
    assert passages.settle(of, start, end, 50).tolist() == [False, False, False, True, False, False]
    assert passages.settle(of, start, end, 15).all()
    assert passages.settle(of[:0], start[:0], end[:0], 50).tolist() == []
