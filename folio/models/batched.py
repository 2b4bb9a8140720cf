"""Many linear text models fitted together: one pass over one count matrix per step serves all of them.

Cross-validation and stacking fit the same learners on many overlapping training sets (the folds). Here
all of them share:

* **one count matrix**: a row per document with its global term ids and counts, written once, without a shuffle. Bags are counted
  from the staged words where they are read, twice, because their strings take more disk than the words;
* **one histogram** of document frequencies, a row per term with a slot per training set, from which
  every set's vocabulary is cut (``min_df``, ``max_df``, the ``max_features`` most frequent, ties by
  term) and its idf computed;
* **one pass per step**: it computes, for every model still running, the loss and gradient over the rows of its
  training set. The executors keep one copy of the entries (memory, then disk) in pieces of rows that belong to the
  same sets; the sums of the partitions are added by model on the executors, so only the totals reach the driver.

Every model runs its own L-BFGS (in the driver, on vectors of at most ``(max_features + 1) x classes``
values) and stops when the largest entry of its gradient is at most ``tol``; the models that are done
leave the pass, and others take their place: at most ``STATE_BYTES`` of solver state are held at a time, however many the
models. The steps are taken in variables scaled by a root of the curvature's diagonal (one pass of squares), which takes
fewer passes to the same tolerance. A model's iterates are the ones a separate fit with the same solver would make.

Objectives, averaged over the n training rows of the set:

* ``logistic``: multinomial cross-entropy + ||W||^2 / (2 C n), intercepts not penalised;
* ``squared_hinge``: one binary machine per class, sum of max(0, 1 - y s)^2 + ||W||^2 / (2 C n),
  intercept penalised like a weight (as a linear SVM that adds a constant feature does);
* ``naive_bayes``: multinomial naive Bayes with additive smoothing ``alpha``, one pass of class sums.

Features: ``counts`` (raw counts), ``tfidf`` ((1 + ln n) x idf, L2-normalised per row) or ``raw``
(values as given, for dense meta features).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.config import MAX_DF, MAX_FEATURES, MIN_DF
from folio.functions.arrays import counted
from folio.operators.ranking import staged_rank
from folio.operators.terms import partial_tallies
from folio.session import stage

TOL = 1e-5
MEMORY = 10
STATE_BYTES = 280 << 20  # of the solvers that run at the same time
NB_MODELS = 8  # naive Bayes models summed in a pass
SLICE_ROWS = 512  # rows turned into entries at once, and scored at once
PIECE_ROWS, PIECE_ENTRIES = 256, 1 << 20  # a piece has rows of several sets up to the first, twice as many of one list of sets, and at most the second


@dataclass(frozen=True)
class Learner:
    name: str
    loss: str  # "logistic", "squared_hinge" or "naive_bayes"
    weighting: str  # "tfidf", "counts" or "raw"
    c: float = 1.0
    max_n: int = 2  # longest n-gram of the vocabulary
    max_iter: int = 1000
    alpha: float = 0.1


@dataclass
class Matrix:
    """The shared rows and, per (set, n-gram space), the map from global term ids to the set's own columns."""

    rows: DataFrame  # id, label_idx, sets, scored, g, n
    spaces: list[tuple[int, int]]  # (set, max_n) of every vocabulary
    local: np.ndarray  # (spaces, G) int32, -1 where the term is not in the vocabulary
    idf: np.ndarray  # (spaces, G)
    width: np.ndarray  # (spaces,) vocabulary sizes
    n_rows: dict[int, int]  # training rows of every set
    k: int
    _kept: RDD | None = None
    _shared: Broadcast | None = None

    def pieces(self) -> RDD:
        """The training rows as arrays, persisted (memory, then disk) for the passes of the solver.

        One copy of the entries (5 bytes each where counts are below 256) serves all sets and weightings: what a set adds is a
        norm per row. One partition
        per core, each a list of bounded pieces, so a pass makes as many partial sums as there are cores, however many the
        rows. A lost executor's blocks are rebuilt from the staged table they come from.
        """
        if self._kept is None:
            sc = self.rows.sparkSession.sparkContext
            sets = sorted(self.n_rows)
            parts = self.shared()
            train = self.rows.where(F.size("sets") > 0).select("label_idx", "sets", "g", "n")
            pieces = train.mapInArrow(lambda batches: _cut(batches, sets, *parts.value[:2]), _PIECE)
            dealt = pieces.repartition(sc.defaultParallelism)  # evenly, however the table's files are split
            self._kept = dealt.rdd.map(lambda r: tuple(bytes(v) for v in r)).persist(StorageLevel.MEMORY_AND_DISK)
        return self._kept

    def shared(self):
        """The maps of the vocabularies, sent to the executors once for all passes."""
        if self._shared is None:
            self._shared = self.rows.sparkSession.sparkContext.broadcast((self.local, self.idf, self.width, self.k))
        return self._shared

    def release(self) -> None:
        if self._kept is not None:
            self._kept.unpersist()
            self._kept = None


def _histogram(base: DataFrame, max_n: int, spaces: Sequence[tuple[int, int]], n_docs: Sequence[int], min_df: int, max_df: float) -> DataFrame:
    """``space, term, df, total, n_docs`` of the terms inside the document frequency limits of a space.

    Bags are added up batch by batch, per term and list of sets; only these sums meet the shuffle, and get their slots (one per
    set) behind it.
    """
    set_ids = sorted({s for s, _ in spaces})
    place = {s: i for i, s in enumerate(set_ids)}
    held = F.array_join(F.col("sets").cast("array<string>"), ",").alias("held")
    source = "words" if "words" in base.columns else "terms"
    tallies = partial_tallies(base.where(F.size("sets") > 0).select(held, source), ["held"], (1, max_n if source == "words" else 1)).repartition("term")
    inside = [F.array_contains(F.split("held", ","), str(s)) for s in set_ids]
    sums = tallies.groupBy("term").agg(
        *[F.sum(F.when(own, F.col("df")).otherwise(0)).alias(f"d{i}") for i, own in enumerate(inside)],
        *[F.sum(F.when(own, F.col("total")).otherwise(0)).alias(f"t{i}") for i, own in enumerate(inside)],
    )
    is_word = ~F.contains(F.col("term"), F.lit(" "))
    cells = [
        F.when(
            F.lit(g > 1) | is_word,
            F.struct(
                F.lit(i).alias("space"),
                F.col(f"d{place[s]}").alias("df"),
                F.col(f"t{place[s]}").alias("total"),
                F.lit(n_docs[i]).cast("long").alias("n_docs"),
            ),
        )
        for i, (s, g) in enumerate(spaces)
    ]
    kept = lambda c: c.isNotNull() & (c["df"] >= min_df) & (c["df"] <= c["n_docs"] * F.lit(max_df))
    frequent = sums.where(F.greatest(F.lit(0), *[F.col(f"d{i}") for i in range(len(set_ids))]) >= min_df)
    return frequent.select("term", F.explode(F.filter(F.array(*cells), kept)).alias("c")).select(
        "c.space", "term", "c.df", "c.total", "c.n_docs"
    )


def _vocabularies(histogram: DataFrame, max_features: int) -> DataFrame:
    """``space, term, df, n_docs`` of the most frequent terms of each space."""
    pruned = stage(histogram, "batched-stats")
    # per space: the total at which the cut falls, from the (small) table of totals
    sizes = pruned.groupBy("space", "total").agg(F.count(F.lit(1)).alias("terms"))
    through = F.sum("terms").over(Window.partitionBy("space").orderBy(F.desc("total")))
    cuts = (
        sizes.withColumn("through", through)
        .where(F.col("through") > max_features)
        .groupBy("space")
        .agg(F.max_by(F.struct("total", "through", "terms"), "total").alias("at"))
        .select("space", F.col("at.total").alias("cut"), (F.lit(max_features) - F.col("at.through") + F.col("at.terms")).alias("spare"))
    )
    marked = pruned.join(cuts, "space", "left")
    above = marked.where(F.col("cut").isNull() | (F.col("total") > F.col("cut")))
    ties = staged_rank(marked.where(F.col("total") == F.col("cut")), ["space"], ["term"], "tie")
    return above.select("space", "term", "df", "n_docs").unionByName(
        ties.where(F.col("tie") <= F.col("spare")).select("space", "term", "df", "n_docs")
    )


def build_matrix(
    rows: DataFrame,
    learners: Sequence[Learner],
    k: int,
    *,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    max_features: int = MAX_FEATURES,
) -> Matrix:
    """``rows``: ``id, label_idx, sets, scored`` and ``words`` (cleaned) or ``terms`` (one- and two-word terms, as cleaned)."""
    grams = sorted({learner.max_n for learner in learners})
    source = "words" if "words" in rows.columns else "terms"
    base = stage(rows.select("id", "label_idx", "sets", "scored", source), "batched-rows")
    per_set = base.select(F.explode("sets").alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("n_docs"))
    n_rows = {r["set"]: r["n_docs"] for r in per_set.collect()}
    spaces = [(s, g) for s in sorted(n_rows) for g in grams]
    n_docs = [n_rows[s] for s, _ in spaces]
    histogram = _histogram(base, grams[-1], spaces, n_docs, min_df, max_df)
    vocab = stage(_vocabularies(histogram, max_features), "batched-vocab")
    # capped: at most max_features terms a space; a term that several spaces hold comes once
    table = vocab.groupBy("term").agg(F.collect_list(F.struct("space", "df")).alias("held")).toArrow().sort_by("term").combine_chunks()
    terms, held = table["term"].combine_chunks(), table["held"].combine_chunks()
    g = np.repeat(np.arange(len(terms)), held.value_lengths().to_numpy())
    space, df = (held.flatten().field(name).to_numpy().astype(np.int64) for name in ("space", "df"))
    local_of = np.full((len(spaces), len(terms)), -1, dtype=np.int32)
    idf = np.zeros((len(spaces), len(terms)))
    idf[space, g] = np.log((1.0 + np.array(n_docs, dtype=float)[space]) / (1.0 + df)) + 1
    local_of[space, g] = 0
    for row in local_of:  # columns of a space in the order of its terms
        row[row == 0] = np.arange(np.count_nonzero(row == 0), dtype=np.int32)
    width = np.bincount(space, minlength=len(spaces))
    known = base.sparkSession.sparkContext.broadcast(terms.cast(pa.string()))
    id_type = base.schema["id"].dataType.simpleString()
    matrix = base.select("id", F.col("label_idx").cast("int").alias("label_idx"), "sets", "scored", source).mapInArrow(
        lambda batches: _entries(batches, known.value, source, grams[-1] if source == "words" else 1),
        f"id {id_type}, label_idx int, sets array<int>, scored array<int>, g array<int>, n array<double>",
    )
    return Matrix(stage(matrix, "batched-matrix"), spaces, local_of, idf, width, n_rows, k)


# ---------------------------------------------------------------- inside the tasks


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().fill_null(0).to_numpy()
    return values, np.repeat(np.arange(len(column)), lengths)


def _features(entries, rows_mask, space, weighting, local, idf):
    """Entries (row in the selection, column, value) of the selected rows in one vocabulary."""
    g, g_row, n = entries
    keep = rows_mask[g_row]
    g, n, row = g[keep], n[keep], g_row[keep]
    j = local[space][g]
    known = j >= 0
    g, n, row, j = g[known], n[known], row[known], j[known]
    position = np.cumsum(rows_mask) - 1
    row = position[row]
    if weighting == "tfidf":
        v = (1.0 + np.log(n)) * idf[space][g]
        norm = np.sqrt(np.bincount(row, weights=v * v, minlength=int(rows_mask.sum())))
        v = v / norm[row]
    else:
        v = n
    return row, j, v


def _scores(row, j, v, w, b, n):
    k = w.shape[1]
    return np.stack([np.bincount(row, weights=v * w[j, c], minlength=n) for c in range(k)], 1) + b


def _softmax(s):
    s = s - s.max(1, keepdims=True)
    e = np.exp(s)
    return e / e.sum(1, keepdims=True)


def _entries(batches: Iterator[pa.RecordBatch], terms: pa.Array, source: str, max_n: int) -> Iterator[pa.RecordBatch]:
    """Rows with their known terms as global ids (ascending) and counts; a row without one has empty arrays."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            bag = counted(part.column(source), 1, max_n)
            row = np.repeat(np.arange(len(bag)), bag.value_lengths().fill_null(0).to_numpy())
            flat = bag.flatten()
            place = pc.index_in(flat.field("term"), value_set=terms)
            found = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
            g = place.take(pa.array(found)).to_numpy().astype(np.int32)
            n = flat.field("n").to_numpy(zero_copy_only=False)[found].astype(np.float64)
            row = row[found]
            order = np.lexsort((g, row))
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(bag)))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in ("id", "label_idx", "sets", "scored")],
                    pa.ListArray.from_arrays(offsets, pa.array(g[order])),
                    pa.ListArray.from_arrays(offsets, pa.array(n[order])),
                ],
                names=["id", "label_idx", "sets", "scored", "g", "n"],
            )


def _cut(batches: Iterator[pa.RecordBatch], sets: list[int], local: np.ndarray, idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows as pieces of arrays (``_PIECE``), those of equal ``sets`` together, so that most pieces are wholly in or out of a set."""
    for batch in batches:
        found, set_row = _flat(batch.column("sets"))
        member = np.zeros((len(sets), batch.num_rows), dtype=bool)
        member[np.searchsorted(sets, found), set_row] = True
        labels = batch.column("label_idx").to_numpy().astype(np.int32)
        g, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("g", "n"))
        lengths = batch.column("g").value_lengths().fill_null(0).to_numpy().astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        order = np.lexsort(member[::-1])
        same = np.r_[True, (member[:, order[1:]] == member[:, order[:-1]]).all(0)]
        rows, entries = 0, 0
        cuts = [0]
        for i, r in enumerate(order):
            if (rows >= PIECE_ROWS and not same[i]) or rows >= 2 * PIECE_ROWS or (rows and entries + lengths[r] > PIECE_ENTRIES):
                cuts.append(i)
                rows = entries = 0
            rows, entries = rows + 1, entries + lengths[r]
        for start, stop in zip(cuts, [*cuts[1:], len(order)]):
            of = order[start:stop]
            size = lengths[of]
            at = np.repeat(begins[of] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            pg, pn = g[at].astype(np.int32), n[at].astype(np.float64)
            row = np.repeat(np.arange(len(of)), size)
            weight = 1.0 + np.log(np.maximum(pn, 1e-300))
            norms = np.stack([np.sqrt(np.bincount(row, weights=(weight * idf[s][pg] * (local[s][pg] >= 0)) ** 2, minlength=len(of))) for s in range(len(idf))])
            scale = np.divide(1.0, norms, out=np.zeros_like(norms), where=norms > 0)
            # values as they are, in the smallest type that holds them all
            kind = next((c for c in ("u1", "u2", "i4") if pn.size == 0 or (pn.min() >= 0 and pn.max() <= np.iinfo(c).max and (pn == np.floor(pn)).all())), "f8")
            piece = [v.tobytes() for v in (labels[of], member[:, of], size.astype(np.int32), pg, pn.astype(kind))]
            piece += [kind.encode(), scale.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in piece], names=_PIECE_NAMES)


_PIECE_NAMES = ["labels", "member", "lengths", "g", "n", "kind", "scale"]
_PIECE = ", ".join(f"{name} binary" for name in _PIECE_NAMES)
SQUARES = "squares"  # in place of a job's params: sums of squared values


def _errors(learner: Learner, s: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss over the masked rows and its derivative by their scores (classes x rows), zero for other rows."""
    k, n = s.shape
    at = np.arange(n)
    if learner.loss == "logistic":
        s = s - s.max(0)
        p = np.exp(s)
        p /= p.sum(0)
        loss = -np.log(np.maximum(p[y, at], 1e-300))
        p[y, at] -= 1.0
        return float(loss[mask].sum()), p * mask
    sign = -np.ones((k, n))
    sign[y, at] = 1.0
    gap = np.maximum(0.0, 1.0 - sign * s) * mask
    return float((gap * gap).sum()), -2.0 * sign * gap


def _partial(pieces: Iterator[tuple], jobs, parts, learners, set_ids) -> Iterator[tuple]:
    """Per job (model, set, space, learner, params): summed loss and gradient over the pieces of a partition.

    Scores and gradients are products of the one entry list with the set's weights, laid out by global term: a term outside
    the set's vocabulary has weight zero, and its gradient is left out at the end. ``params`` is None for class sums (naive
    Bayes), ``SQUARES`` for the sum of squared values of every column.
    """
    local, idf, width, k = parts
    columns = [np.flatnonzero(row >= 0) for row in local]
    n_terms = local.shape[1]
    weights, sums, losses, biases = {}, {}, {}, {}
    for model, _, space, li, params in jobs:
        squares = isinstance(params, str)
        sums[model], biases[model], losses[model] = np.zeros((1 if squares else k, n_terms)), np.zeros(k), 0.0
        if params is not None and not squares:
            d = int(width[space])
            w = np.zeros((k, n_terms))
            w[:, columns[space]] = params[: d * k].reshape(d, k).T
            weights[model] = (w * idf[space] if learners[li].weighting == "tfidf" else w, params[d * k :, None])
    log_of = 1.0 + np.log(np.maximum(np.arange(256), 1e-300))
    work = np.empty(0)
    for piece in pieces:
        labels, size, g = (np.frombuffer(piece[i], dtype=np.int32) for i in (0, 2, 3))
        g = g.astype(np.intp)
        kind = piece[5].decode()
        n = np.frombuffer(piece[4], dtype=kind)
        member = np.frombuffer(piece[1], dtype=bool).reshape(len(set_ids), -1)
        scale = np.frombuffer(piece[6]).reshape(len(idf), -1)
        filled = np.flatnonzero(size)
        length = size[filled]
        starts = np.cumsum(length, dtype=np.int64) - length
        if len(work) < len(g):
            work = np.empty(len(g))
        buffer = work[: len(g)]
        values = {}
        for model, set_id, space, li, params in jobs:
            mask = member[set_ids.index(set_id)]
            if not mask.any():
                continue
            learner = learners[li]
            tfidf = learner.weighting == "tfidf"
            if tfidf not in values:
                values[tfidf] = n.astype(np.float64) if not tfidf else log_of[n] if kind == "u1" else 1.0 + np.log(np.maximum(n, 1e-300))
            v = values[tfidf]
            if params is None:
                errors = np.zeros((k, len(size)))
                errors[labels, np.arange(len(size))] = mask
            elif isinstance(params, str):
                errors = mask[None].astype(np.float64)
            else:
                w, b = weights[model]
                s = np.zeros((k, len(size)))
                if len(g):
                    for c in range(k):
                        np.take(w[c], g, out=buffer, mode="clip")
                        np.multiply(buffer, v, out=buffer)
                        s[c, filled] = np.add.reduceat(buffer, starts)
                if tfidf:
                    s *= scale[space]
                loss, errors = _errors(learner, s + b, labels, mask)
                losses[model] += loss
            if not isinstance(params, str):
                biases[model] += errors.sum(1)
            if tfidf:
                errors = errors * (scale[space] ** 2 if isinstance(params, str) else scale[space])
            if len(g):
                v = v * v if isinstance(params, str) else v
                for total, error in zip(sums[model], errors):
                    np.multiply(np.repeat(error[filled], length), v, out=buffer)
                    total += np.bincount(g, weights=buffer, minlength=n_terms)
    for model, _, space, li, params in jobs:
        total = sums[model]
        if learners[li].weighting == "tfidf":
            total = total * (idf[space] ** 2 if isinstance(params, str) else idf[space])
        yield model, np.concatenate([[losses[model]], total[:, columns[space]].T.ravel(), biases[model]])


def _evaluate(matrix: Matrix, learners: Sequence[Learner], jobs) -> dict[int, tuple[float, np.ndarray]]:
    """One pass over the kept pieces: summed loss and gradient of every job.

    The partitions' sums are added by job on the executors, so one vector per job reaches the driver; the parts of a
    gradient travel that last way in single precision (class sums, which are counts, in double). Only there: rounded before,
    a model would depend on how rows of other sets are dealt out beside its own.
    """
    sc = matrix.rows.sparkSession.sparkContext
    learner_list, set_ids = list(learners), sorted(matrix.n_rows)
    parts = matrix.shared()
    shipped = sc.broadcast(jobs)
    exact = frozenset(job[0] for job in jobs if job[4] is None)
    try:
        sums = (
            matrix.pieces()
            .mapPartitions(lambda pieces: _partial(pieces, shipped.value, parts.value, learner_list, set_ids))
            .reduceByKey(np.add, min(len(jobs), sc.defaultParallelism))
            .map(lambda kv: (kv[0], float(kv[1][0]), kv[1][1:] if kv[0] in exact else kv[1][1:].astype(np.float32)))
            .collect()
        )
    finally:
        shipped.destroy()
    return {model: (loss, np.asarray(vector, dtype=np.float64)) for model, loss, vector in sums}


# ---------------------------------------------------------------- the solver


def lbfgs(x0: np.ndarray, tol: float, max_iter: int, memory: int = MEMORY, scale: np.ndarray | float = 1.0):
    """L-BFGS with backtracking line search as a generator: it yields points and receives ``(f, g)``.

    Steps are taken in the variables ``x / scale``; ``tol`` bounds the gradient by x. The history is kept in single precision.
    """
    x = x0
    f, g_x = yield x
    g = g_x * scale
    s_list: list[np.ndarray] = []
    y_list: list[np.ndarray] = []
    for _ in range(max_iter):
        if np.max(np.abs(g_x), initial=0.0) <= tol:
            break
        q = g.copy()
        alphas = []
        for s, y in zip(reversed(s_list), reversed(y_list)):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if y_list:
            q *= (s_list[-1] @ y_list[-1]) / (y_list[-1] @ y_list[-1])
        for (s, y), a in zip(zip(s_list, y_list), reversed(alphas)):
            q += s * (a - (y @ q) / (y @ s))
        direction = -q
        slope = g @ direction
        if slope >= 0:
            direction, slope = -g, -(g @ g)
            s_list.clear()
            y_list.clear()
        step = 1.0 if y_list else min(1.0, 1.0 / max(np.max(np.abs(g)), 1e-12))
        while True:
            x_new = x + step * scale * direction
            f_new, g_x = yield x_new
            if f_new <= f + 1e-4 * step * slope or step < 1e-12:
                break
            step *= 0.5
        g_new = g_x * scale
        s, y = (x_new - x) / scale, g_new - g
        if s @ y > 1e-12:
            s_list.append(s.astype(np.float32))
            y_list.append(y.astype(np.float32))
            if len(s_list) > memory:
                s_list.pop(0)
                y_list.pop(0)
        x, f, g = x_new, f_new, g_new
    return x


def _state_bytes(size: int) -> int:
    """What a running solver holds: its history in single precision, and about six vectors."""
    return size * (2 * MEMORY * 4 + 6 * 8)


def _scale(learner: Learner, squares: np.ndarray, n: int, k: int) -> np.ndarray:
    """A power of the inverse of a bound of the curvature's diagonal, per weight and intercept.

    Half of it each way (the fourth root) took the fewest passes for weights of unit rows, a little less for counts.
    """
    power = -0.25 if learner.weighting == "tfidf" else -0.1875
    bend = 0.25 if learner.loss == "logistic" else 2.0
    ridge = 1.0 / (learner.c * n)
    return np.r_[np.repeat(bend * squares / n + ridge, k), np.full(k, bend + ridge)] ** power


@dataclass
class Fitted:
    """Weights (d x k) and intercepts of every (set, learner)."""

    matrix: Matrix
    learners: tuple[Learner, ...]
    params: dict[tuple[int, int], np.ndarray]


def fit(matrix: Matrix, learners: Sequence[Learner], tol: float = TOL) -> Fitted:
    """Fit every learner on every training set of the matrix, all in the same passes."""
    learners = tuple(learners)
    k = matrix.k
    models = []
    for li, learner in enumerate(learners):
        for set_id in sorted(matrix.n_rows):
            space = matrix.spaces.index((set_id, learner.max_n))
            models.append((set_id, li, space))
    params: dict[tuple[int, int], np.ndarray] = {}
    # naive Bayes: one pass of class sums
    nb = [(m, s, sp, li) for m, (s, li, sp) in enumerate(models) if learners[li].loss == "naive_bayes"]
    if nb:
        sums = {}
        for at in range(0, len(nb), NB_MODELS):
            sums |= _evaluate(matrix, learners, [(m, s, sp, li, None) for m, s, sp, li in nb[at : at + NB_MODELS]])
        for m, s, sp, li in nb:
            d = int(matrix.width[sp])
            flat = sums.get(m, (0.0, np.zeros(d * k + k)))[1]
            counts, classes = flat[: d * k].reshape(d, k), flat[d * k :]
            alpha = learners[li].alpha
            w = np.log((counts + alpha) / (counts.sum(0) + alpha * d))
            b = np.log(np.maximum(classes, 1e-300) / max(classes.sum(), 1.0))
            params[(s, li)] = np.concatenate([w.ravel(), b])
    # the others: one L-BFGS per model, every step's points evaluated together
    solvers, pending = {}, {}
    shape = {m: (s, li, sp, int(matrix.width[sp])) for m, (s, li, sp) in enumerate(models) if learners[li].loss != "naive_bayes"}
    waiting = list(shape)
    while waiting or pending:
        begun, held = [], sum(_state_bytes(pending[m].size) for m in pending)
        while waiting:
            size = (shape[waiting[0]][3] + 1) * k
            if (pending or begun) and held + _state_bytes(size) > STATE_BYTES:
                break
            held += _state_bytes(size)
            begun.append(waiting.pop(0))
        if begun:
            squares = _evaluate(matrix, learners, [(m, shape[m][0], shape[m][2], shape[m][1], SQUARES) for m in begun])
            for m in begun:
                s, li, sp, d = shape[m]
                scale = _scale(learners[li], squares.get(m, (0.0, np.zeros(d)))[1][:d], max(matrix.n_rows[s], 1), k)
                solvers[m] = lbfgs(np.zeros(d * k + k), tol, learners[li].max_iter, scale=scale)
                pending[m] = next(solvers[m])
        jobs = [(m, shape[m][0], shape[m][2], shape[m][1], x) for m, x in pending.items()]
        sums = _evaluate(matrix, learners, jobs)
        for m, x in list(pending.items()):
            s, li, sp, d = shape[m]
            learner = learners[li]
            n = max(matrix.n_rows[s], 1)
            loss, grad = sums.get(m, (0.0, np.zeros(x.size)))
            reg = x.copy()
            if learner.loss == "logistic":
                reg[d * k :] = 0.0
            f = loss / n + (reg @ reg) / (2 * learner.c * n)
            g = grad / n + reg / (learner.c * n)
            try:
                pending[m] = solvers[m].send((f, g))
            except StopIteration as done:
                params[(s, li)] = done.value
                del pending[m], solvers[m]
    matrix.release()
    return Fitted(matrix, learners, params)


def _score(batches: Iterator[pa.RecordBatch], jobs, matrix_parts, learners) -> Iterator[pa.RecordBatch]:
    local, idf, width, k = matrix_parts
    for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
        scored, scored_row = _flat(batch.column("scored"))
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        out_id, out_set, out_learner, out_p = [], [], [], []
        for set_id, space, li, params in jobs:
            learner = learners[li]
            mask = np.zeros(batch.num_rows, dtype=bool)
            mask[scored_row[scored == set_id]] = True
            if not mask.any():
                continue
            d = int(width[space])
            g, g_row = _flat(batch.column("g"))
            n, _ = _flat(batch.column("n"))
            row, j, v = _features((g, g_row, n), mask, space, learner.weighting, local, idf)
            s = _scores(row, j, v, params[: d * k].reshape(d, k), params[d * k :], int(mask.sum()))
            p = _softmax(s) if learner.loss != "squared_hinge" else s
            out_id.append(ids[mask])
            out_set.append(np.full(int(mask.sum()), set_id, dtype=np.int32))
            out_learner.append(np.full(int(mask.sum()), li, dtype=np.int32))
            out_p.extend(list(p))
        if out_id:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out_id)),
                    pa.array(np.concatenate(out_set)),
                    pa.array(np.concatenate(out_learner)),
                    pa.array(out_p, pa.list_(pa.float64())),
                ],
                names=["id", "set", "learner", "scores"],
            )


def predict(fitted: Fitted) -> DataFrame:
    """``id, set, learner, scores`` for every row and every set that lists it in ``scored``.

    Scores are class probabilities, except for ``squared_hinge``, whose scores are the machines' decision values.
    """
    matrix = fitted.matrix
    sc = matrix.rows.sparkSession.sparkContext
    jobs = [(s, matrix.spaces.index((s, fitted.learners[li].max_n)), li, p) for (s, li), p in fitted.params.items()]
    shipped = sc.broadcast(jobs)
    parts = matrix.shared()
    learners = fitted.learners
    id_type = matrix.rows.schema["id"].dataType.simpleString()
    return matrix.rows.select("id", "scored", "g", "n").mapInArrow(
        lambda it: _score(it, shipped.value, parts.value, learners),
        f"id {id_type}, set int, learner int, scores array<double>",
    )


def dense_matrix(rows: DataFrame, width: int, k: int) -> Matrix:
    """A matrix of dense features: ``rows`` has ``id, label_idx, sets, scored, x`` (``width`` values, used as they are)."""
    ready = rows.select(
        "id",
        F.col("label_idx").cast("int").alias("label_idx"),
        "sets",
        "scored",
        F.sequence(F.lit(0), F.lit(width - 1)).alias("g"),
        F.col("x").cast("array<double>").alias("n"),
    )
    staged = stage(ready, "batched-dense")
    set_ids = sorted(r[0] for r in staged.select(F.explode("sets")).distinct().collect())
    counts = {r[0]: r[1] for r in staged.select(F.explode("sets")).groupBy("col").count().collect()}
    spaces = [(s, 1) for s in set_ids]
    local = np.tile(np.arange(width, dtype=np.int32), (len(spaces), 1))
    return Matrix(staged, spaces, local, np.ones((len(spaces), width)), np.full(len(spaces), width), counts, k)
