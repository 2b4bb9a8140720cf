"""A gated recurrent language model in numpy that scores whole documents."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.session import stage

# Smoothing of the base score and the share of documents held out.
SMOOTHING = 0.1
HELD_OUT_OF = 10

CLASSES = MEMBERS = 32
VOCABULARY = CLASSES * MEMBERS
BUCKETS = 63  # classes of words outside the vocabulary, by their last characters
HIDDEN = 24
WINDOW = 16  # steps that gradients flow back through
LANES = 64  # streams trained at once
SCORE_LANES, SCORE_WINDOW = 256, 16
SORTED_WINDOWS = 64  # windows whose tokens are sorted at once
SAFE_SCORE = 60  # the exponential of such a score, added up or divided by, stays within a float
RATE = 0.15
ROUNDS = 2
# Gradients, like all counts, come from every training document, each read once: a round takes one of ROUNDS disjoint
# parts. A larger number leaves that share of the documents out of the gradients.
GRADIENT_SHARE = 1
# Words counted in place and not by a shuffle: the most frequent of all training documents. The network's own words are
# the first of them.
FREQUENT = 128_000
GROUP_BYTES = 6 << 20


def bucket(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) % BUCKETS


def is_held_out(key: Column) -> Column:
    """By the CRC-32 of the id as text; a null id counts as empty text, which is held out."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(HELD_OUT_OF)) == 0


class Codes:
    """Word to code: frequent words have the codes 1, 2, ...; 0 is the end; others share codes by bucket."""

    def __init__(self, words: list[bytes]):
        self.words, self.fixed = pa.array(words, pa.binary()), len(words) + 1

    def __getitem__(self, word: bytes) -> int:
        return int(self.of(pa.array([word], pa.binary()))[0])

    def of(self, words: pa.Array) -> np.ndarray:
        """Codes of some words; each distinct ending of the words that are not frequent is hashed once."""
        found = pc.index_in(words, value_set=self.words)
        code = found.fill_null(-1).to_numpy() + 1
        rare = np.flatnonzero(code == 0)
        endings = pc.binary_slice(words.take(pa.array(rare)), -3).dictionary_encode()
        buckets = np.fromiter(map(bucket, endings.dictionary.to_pylist()), np.int32, len(endings.dictionary))
        code[rare] = self.fixed + buckets[endings.indices.to_numpy()]
        return code

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of an array of texts (strings): the codes of its distinct words, words per text, the distinct words and each word's
        place among them."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        table = split.flatten().cast(pa.binary()).dictionary_encode()
        word, counts = table.indices.to_numpy(), pc.list_value_length(split).to_numpy()
        empty = pc.index(table.dictionary, b"").as_py()  # white space at an end leaves an empty piece
        if empty >= 0:
            real = word != empty
            counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[real], minlength=len(texts))
            word = word[real]
        return self.of(table.dictionary), counts, table.dictionary, word

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """As ``places``, but with the code of every word, and the distinct words as bytes."""
        codes, counts, distinct, place = self.places(texts)
        return codes[place], counts, distinct.to_pylist(), place


def text_groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of some megabytes of text each; a longer text is a range of its own."""
    return size_groups(pc.binary_length(texts).to_numpy(), limit)


def size_groups(sizes: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """The ranges of texts of these sizes."""
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    yield from ((int(a), int(b)) for a, b in zip(cuts, cuts[1:]) if b > a)


def _softmax(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials in place of the scores, the log probability of each row's target, and the rows' sums.

    ``target`` is a column by row. Scores of a usual size need no largest score taken off. Else it is found by halving, which takes whole columns at a time;
    the width is a power of two.
    """
    return _softmax_at(x, np.arange(0, x.size, x.shape[1]) + target)


def _softmax_at(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_softmax``, with the targets' places among all scores."""
    if len(x) and (x.max() > SAFE_SCORE or x.min() < -SAFE_SCORE):
        top, width = x, x.shape[1]
        while width > 1:
            width //= 2
            top = np.maximum(top[:, :width], top[:, width:])
        x -= top
    chosen = x.ravel().take(at)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return x, chosen - np.log(total), total


def _run_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows that begin at ``first``."""
    new = np.zeros((1, len(rows)), bool)
    new[0, first] = True
    return Runs(new).sums(rows.copy(), 0)


class Runs:
    """Runs of rows of windows (a row of ``new`` each, which is true where a run begins) and the additions that sum them up.

    Each round adds every second row of a run to the one before it.
    """

    def __init__(self, new: np.ndarray):
        windows, n = new.shape
        at = np.arange(n, dtype=np.int32)
        place = at - np.maximum.accumulate(np.where(new, at, 0), 1)
        stops = np.full((windows, n + 1), n, np.int32)
        np.copyto(stops[:, :n], at, where=new)
        left = np.minimum.accumulate(stops[:, ::-1], 1)[:, ::-1][:, 1:] - at
        self.first, self.cuts = self._dealt(new)
        self.rounds, step = [], 1
        while (pairs := (place & (2 * step - 1) == 0) & (left > step)).any():
            self.rounds.append((step, *self._dealt(pairs)))
            step *= 2

    @staticmethod
    def _dealt(chosen: np.ndarray) -> tuple[np.ndarray, list[int]]:
        window, at = np.nonzero(chosen)
        return at, np.searchsorted(window, np.arange(len(chosen) + 1)).tolist()

    def starts(self, window: int) -> np.ndarray:
        return self.first[self.cuts[window] : self.cuts[window + 1]]

    def sums(self, rows: np.ndarray, window: int) -> np.ndarray:
        """Of a window's rows, which are changed."""
        for step, every, cuts in self.rounds:
            at = every[cuts[window] : cuts[window + 1]]
            if len(at):
                added = rows.take(at, 0)
                added += rows.take(at + step, 0)
                rows[at] = added
        return rows.take(self.starts(window), 0)


class Inputs:
    """Inputs of windows (a row each), sorted, so that those of one token lie next to each other."""

    def __init__(self, inputs: np.ndarray):
        inputs = inputs.astype(np.int16, copy=False)
        self.order = np.argsort(inputs, 1, kind="stable")
        self.ranked = np.take_along_axis(inputs, self.order, 1)
        new = np.ones(inputs.shape, bool)
        np.not_equal(self.ranked[:, 1:], self.ranked[:, :-1], out=new[:, 1:])
        self.runs = Runs(new)

    def sums(self, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a window and the sums of their rows."""
        read = self.ranked[window].take(self.runs.starts(window))
        return read, self.runs.sums(rows.take(self.order[window], 0), window)


class Targets:
    """Targets of windows (a row each), sorted, so that the states of a class lie next to each other."""

    def __init__(self, targets: np.ndarray):
        targets = targets.astype(np.int16, copy=False)
        self.order = np.argsort(targets, 1, kind="stable")
        ranked = np.take_along_axis(targets, self.order, 1)
        group, member = ranked // MEMBERS, ranked % MEMBERS
        offset = CLASSES * np.arange(len(targets))[:, None]
        sizes = np.bincount((group + offset).ravel(), minlength=CLASSES * len(targets)).reshape(-1, CLASSES)
        self.cuts = np.concatenate([np.zeros((len(targets), 1), np.int64), np.cumsum(sizes, 1)], 1).tolist()
        # places among the scores of classes, then of members
        self.picks = np.concatenate([group, member], 1) + MEMBERS * np.arange(2 * targets.shape[1])

    def parts(self, window: int) -> list[tuple[int, slice]]:
        cuts = self.cuts[window]
        return [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


class Space:
    """Arrays of one window of ``steps`` x ``lanes``, used again for the next one, and views of their steps.

    A lane is a column in them, so that gates are whole blocks of rows.
    """

    def __init__(self, steps: int, lanes: int, kind: np.dtype, backward: bool = False):
        n, wide = steps * lanes, 2 * HIDDEN
        self.shape = steps, lanes
        self.rows = np.empty((n, 3 * HIDDEN), kind)
        self.x = np.empty((steps, 3 * HIDDEN, lanes), kind)  # sums, then gates (as 1 / value) and new values
        self.hu = np.empty((3 * HIDDEN, lanes), kind)
        self.states = np.empty((steps + 1, HIDDEN, lanes), kind)
        self.reset = np.empty((steps, HIDDEN, lanes), kind)  # h @ u of the new value times its gate
        self.by_row = np.ones((n + lanes, HIDDEN + 1), kind)  # states as rows, with a one for the bias
        self.steps = [(s, x[:wide], x[:HIDDEN], x[HIDDEN:wide], x[wide:], r, h) for s, x, r, h in zip(self.states, self.x, self.reset, self.states[1:])]
        if backward:
            self.errors = np.empty((steps, HIDDEN, lanes), kind)
            # of the error of a state: the errors of the three sums of h @ u, of the new value, of the state before
            self.back = np.empty((steps, 5, HIDDEN, lanes), kind)
            self.rises = self.back.reshape(steps, 5 * HIDDEN, lanes)[:, : 3 * HIDDEN]
            self.steps_back = list(enumerate(zip(self.errors, self.back, self.rises, self.back[:, 4])))[::-1]
            self.error_before = np.empty((HIDDEN, lanes), kind)
            self.hu_rows = np.empty((n, HIDDEN), kind)

    def state_rows(self) -> np.ndarray:
        steps, lanes = self.shape
        self.by_row.reshape(steps + 1, lanes, HIDDEN + 1)[:, :, :HIDDEN] = self.states.transpose(0, 2, 1)
        return self.by_row[lanes:]


class Gru:
    """Input table, recurrent weights and a softmax in two factors: the class of the next token, then its member.

    The last row of the weights of a softmax (``c``, ``m``) is its bias.
    """

    SHAPES = (
        ("x", (VOCABULARY, 3 * HIDDEN)),
        ("u", (HIDDEN, 3 * HIDDEN)),
        ("c", (HIDDEN + 1, CLASSES)),
        ("m", (CLASSES, HIDDEN + 1, MEMBERS)),
    )

    def __init__(self, flat: np.ndarray):
        self.flat, self.p, at = flat, {}, 0
        for name, shape in self.SHAPES:
            size = int(np.prod(shape))
            self.p[name] = flat[at : at + size].reshape(shape)
            at += size
        c, m = self.p["c"], self.p["m"]
        self.p |= {"wc": c[:HIDDEN], "bc": c[HIDDEN], "wm": m[:, :HIDDEN], "bm": m[:, HIDDEN]}

    @classmethod
    def start(cls, counts: np.ndarray) -> Gru:
        """Small random weights; biases that give every token its smoothed share of ``counts``."""
        rng = np.random.default_rng(7)
        model = cls(np.zeros(sum(int(np.prod(s)) for _, s in cls.SHAPES), np.float32))
        for name in ("x", "u", "wc", "wm"):
            model.p[name][:] = rng.normal(0, 0.1, model.p[name].shape)
        share = (counts + SMOOTHING).reshape(CLASSES, MEMBERS)
        model.p["bc"][:] = np.log(share.sum(1) / share.sum())
        model.p["bm"][:] = np.log(share / share.sum(1, keepdims=True))
        return model

    def step(self, tokens: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, Space]:
        """A document's first step reads the end token 0 and starts from an empty state."""
        space = Space(1, len(tokens), h.dtype)
        self._states(tokens[None], self._ends(tokens[None]), h.T, space)
        return space.states[1].T, space

    @staticmethod
    def _ends(inputs: np.ndarray) -> list[np.ndarray | None]:
        """By step, the lanes that read the end token."""
        at, lane = np.nonzero(inputs == 0)
        cuts = np.searchsorted(at, np.arange(len(inputs) + 1)).tolist()
        return [lane[a:b] if b > a else None for a, b in zip(cuts, cuts[1:])]

    def _states(self, inputs: np.ndarray, ends: list[np.ndarray | None], h: np.ndarray, space: Space) -> None:
        """States after each step of a window that begins with the states ``h`` (columns)."""
        steps, lanes = inputs.shape
        self.p["x"].take(inputs.ravel(), 0, out=space.rows, mode="clip")
        hu, wide = space.hu, 2 * HIDDEN
        space.x[:] = space.rows.reshape(steps, lanes, -1).transpose(0, 2, 1)
        u = np.ascontiguousarray(self.p["u"].T)
        np.negative(u[:wide], out=u[:wide])  # a gate is 1 / (1 + exp(-sum))
        space.states[0] = h
        gates_u, new_u = hu[:wide], hu[wide:]
        with np.errstate(over="ignore"):
            for ended, (before, gates, z, r, n, reset, h) in zip(ends, space.steps):
                if ended is not None:
                    before = before.copy()
                    before[:, ended] = 0
                np.dot(u, before, out=hu)
                np.subtract(gates_u, gates, out=gates)
                np.exp(gates, out=gates)
                gates += 1
                np.divide(new_u, r, out=reset)
                n += reset
                np.tanh(n, out=n)
                np.subtract(before, n, out=h)
                h /= z
                h += n

    def log_prob(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target."""
        rows = np.ones((len(h), HIDDEN + 1), h.dtype)
        rows[:, :HIDDEN] = h
        ranked = Targets(targets[None])
        found = np.empty(len(h), h.dtype)
        found[ranked.order[0]] = self._output(rows, ranked, 0)
        return found

    def _output(self, rows: np.ndarray, ranked: Targets, window: int, grad: Gru | None = None) -> np.ndarray:
        """Log probability of each target in their sorted order; with ``grad`` adds to it and returns the error of the states."""
        hc, parts, n = rows.take(ranked.order[window], 0), ranked.parts(window), len(rows)
        scores, c, m = np.empty((2 * n, MEMBERS), rows.dtype), self.p["c"], self.p["m"]
        of_class, of_member = scores[:n], scores[n:]
        np.dot(hc, c, out=of_class)
        for group, part in parts:
            np.dot(hc[part], m[group], out=of_member[part])
        picks = ranked.picks[window]
        powers, found, sums = _softmax_at(scores, picks)
        if grad is None:
            return found[:n] + found[n:]
        powers /= sums[:, None]
        flat = powers.ravel()
        flat[picks] -= 1
        grad.p["c"] += hc.T @ of_class
        errors, others, grad_m, m = of_class @ c[:HIDDEN].T, np.empty((n, HIDDEN), rows.dtype), grad.p["m"], m[:, :HIDDEN].transpose(0, 2, 1)
        for group, part in parts:
            error = of_member[part]
            np.dot(hc[part].T, error, out=grad_m[group])
            np.dot(error, m[group], out=others[part])
        errors += others
        return errors

    def train_window(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, Gru]:
        """Gradient of one window (steps x lanes) and the state after it; gradients stop at its start."""
        grad, space = Gru(np.zeros_like(self.flat)), Space(*inputs.shape, h.dtype, backward=True)
        read, rows = self._window(inputs, self._ends(inputs), Inputs(inputs.reshape(1, -1)), Targets(targets.reshape(1, -1)), 0, h.T, grad, space)
        grad.p["x"][read] = rows
        return space.states[-1].T, grad

    def _window(
        self, inputs: np.ndarray, ends: list, tokens: Inputs, ranked: Targets, window: int, h: np.ndarray, grad: Gru, space: Space
    ) -> tuple[np.ndarray, np.ndarray]:
        """Runs a window in ``space``; adds its gradient to ``grad``, but that of the input table is returned: tokens and their rows."""
        (steps, lanes), wide = inputs.shape, 2 * HIDDEN
        self._states(inputs, ends, h, space)
        found = self._output(space.state_rows(), ranked, window, grad)
        errors = np.empty_like(found)
        errors[ranked.order[window]] = found
        space.errors[:] = errors.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1)
        rest, r, news = space.x[:, :HIDDEN], space.x[:, HIDDEN:wide], space.x[:, wide:]
        # first what the error of a state is multiplied by
        to_z, to_r, to_hu, to_n, keep = (space.back[:, i] for i in range(5))
        np.reciprocal(rest, out=keep)
        np.subtract(1, keep, out=rest)
        np.reciprocal(r, out=r)
        np.multiply(news, news, out=to_n)
        np.subtract(1, to_n, out=to_n)
        to_n *= rest
        np.subtract(space.states[1:], news, out=to_z)
        to_z *= rest
        np.subtract(1, r, out=to_r)
        to_r *= space.reset
        to_r *= to_n
        np.multiply(to_n, r, out=to_hu)
        u, error_before = self.p["u"], space.error_before
        error_before[:] = 0
        for t, (error, factors, rise, kept) in space.steps_back:
            error += error_before
            factors *= error
            np.dot(u, rise, out=error_before)
            error_before += kept
            if ends[t] is not None:
                error_before[:, ends[t]] = 0
        rows = space.rows.reshape(steps, lanes, -1)
        rows[:, :, :wide] = space.rises[:, :wide].transpose(0, 2, 1)
        rows[:, :, wide:] = to_n.transpose(0, 2, 1)
        space.hu_rows.reshape(steps, lanes, HIDDEN)[:] = to_hu.transpose(0, 2, 1)
        befores = space.by_row[:-lanes, :HIDDEN]
        for t, ended in enumerate(ends):
            if ended is not None:
                befores[t * lanes + ended] = 0
        grad_u = grad.p["u"]
        grad_u[:, :wide] += befores.T @ space.rows[:, :wide]
        grad_u[:, wide:] += befores.T @ space.hu_rows
        return tokens.sums(space.rows, window)

    def train(self, stream: np.ndarray, squares: np.ndarray) -> None:
        """One pass over a stream of documents, cut into lanes; the state is carried from window to window."""
        lanes = min(LANES, max(1, len(stream) // (2 * WINDOW)))
        length = len(stream) // lanes
        if length < 2:
            return
        lane = np.ascontiguousarray(stream[: lanes * length].reshape(lanes, length).T)
        ends = self._ends(lane)
        h = np.zeros((HIDDEN, lanes), np.float32)
        # rows of the input table that a window doesn't read have no gradient: they and their squares stay as they are
        table, rest = self.p["x"], self.p["x"].size
        table_squares, rest_squares = squares[:rest].reshape(table.shape), squares[rest:]
        grad = Gru(np.zeros_like(self.flat))
        others, weights, roots = grad.flat[rest:], self.flat[rest:], np.empty_like(rest_squares)
        space = Space(min(WINDOW, length - 1), lanes, h.dtype, backward=True)
        for begin in range(0, length - 1, SORTED_WINDOWS * WINDOW):
            end = min(begin + SORTED_WINDOWS * WINDOW, length - 1)
            for first, last in ((begin, end - (end - begin) % WINDOW), (end - (end - begin) % WINDOW, end)):
                if first == last:
                    continue
                steps = min(WINDOW, last - first)
                if steps != space.shape[0]:
                    space = Space(steps, lanes, h.dtype, backward=True)
                inputs = lane[first:last].reshape(-1, steps, lanes)
                tokens = Inputs(inputs.reshape(len(inputs), -1))
                ranked = Targets(lane[first + 1 : last + 1].reshape(len(inputs), -1))
                for window in range(len(inputs)):
                    others[:] = 0
                    at = first + window * steps
                    read, rows = self._window(inputs[window], ends[at : at + steps], tokens, ranked, window, h, grad, space)
                    h = space.states[-1]
                    norm = np.sqrt(np.vdot(others, others) + np.vdot(rows, rows)) / (steps * lanes)
                    by = float(min(1.0, 5.0 / (norm + 1e-12)) / (steps * lanes))
                    others *= by
                    rows *= by
                    np.multiply(others, others, out=roots)
                    rest_squares += roots
                    np.sqrt(rest_squares, out=roots)
                    others *= RATE
                    others /= roots
                    weights -= others
                    found = rows * rows
                    found += table_squares.take(read, 0)
                    table_squares[read] = found
                    np.sqrt(found, out=found)
                    rows *= RATE
                    rows /= found
                    np.subtract(table.take(read, 0), rows, out=rows)
                    table[read] = rows

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each document, its end included.

        Documents are dealt to lanes of about equal length, the longest first; a lane reads its documents one after the
        other, and its state goes on from window to window until a document ends.
        """
        lanes: list[list[int]] = [[] for _ in range(min(SCORE_LANES, len(docs)))]
        heap = [(0, i) for i in range(len(lanes))]
        for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
            size, i = heapq.heappop(heap)
            lanes[i].append(d)
            heapq.heappush(heap, (size + len(docs[d]) + 1, i))
        lengths = [sum(len(docs[d]) + 1 for d in lane) for lane in lanes]
        order = sorted(range(len(lanes)), key=lambda i: -lengths[i])
        lanes, lengths = [lanes[i] for i in order], np.array([lengths[i] for i in order])
        steps = int(lengths[0])
        tokens = np.zeros((steps + 1, len(lanes)), np.int16)  # row 0: the end before the first document
        owner = np.zeros((steps, len(lanes)), np.int32)
        for i, lane in enumerate(lanes):
            at = 0
            for d in lane:
                tokens[at + 1 : at + 1 + len(docs[d]), i] = docs[d]
                owner[at : at + len(docs[d]) + 1, i] = d
                at += len(docs[d]) + 1
        totals = np.zeros(len(docs))
        h, space = np.zeros((HIDDEN, len(lanes)), np.float32), None
        for start in range(0, steps, SCORE_WINDOW):
            active = int((lengths > start).sum())
            window = slice(start, min(start + SCORE_WINDOW, steps))
            inputs = tokens[window, :active]
            if space is None or space.shape != inputs.shape:
                space = Space(*inputs.shape, np.dtype(np.float32))
            self._states(inputs, self._ends(inputs), h[:, :active], space)
            h = space.states[-1]
            ranked = Targets(tokens[start + 1 : window.stop + 1, :active].reshape(1, -1))
            order = ranked.order[0]
            found = self._output(space.state_rows(), ranked, 0)
            real = (np.arange(start, window.stop)[:, None] < lengths[:active]).ravel().take(order)
            totals += np.bincount(owner[window, :active].ravel().take(order), np.where(real, found, 0), len(docs))
        return totals


def _frequent(rows: DataFrame, size: int) -> list[bytes]:
    """Most frequent words of all training rows, by their exact counts; equal counts in word order."""
    return [word for word, _ in _frequent_counts(rows, size)]


def _frequent_counts(rows: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """The words of ``_frequent`` with their counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few groups, because a word is shuffled once per group
            for start, stop in text_groups(batch.column(0), 4 * GROUP_BYTES):
                texts = batch.column(0)[start:stop]
                words = pc.ascii_split_whitespace(pc.ascii_lower(texts)).flatten().cast(pa.binary()).value_counts()
                word, n = words.field("values"), words.field("counts")
                size = pc.binary_length(word)
                kept = pc.and_(pc.greater(size, 0), pc.less_equal(size, 64))
                yield pa.RecordBatch.from_arrays([word.filter(kept), n.filter(kept)], names=["word", "n"])

    pieces = rows.where(~F.col("held_out")).select("text").mapInArrow(split, "word binary, n long")
    counted = stage(pieces.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    # tasks send the driver only words whose count is that of a chosen one
    least, above = 1, 0
    for r in sorted(counted.groupBy("n").count().collect(), reverse=True):
        least, above = r["n"], above + r["count"]
        if above >= size:
            break
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size)
    return [(bytes(r["word"]), r["n"]) for r in top.collect()]


def _counts(rows: DataFrame, words, tables) -> DataFrame:
    """Staged rows of two kinds: each document's rare words ``word, bucket, key, n, train``, and the document itself.

    ``word`` is a 64-bit hash. A document has no ``word`` but ``n = 1``, which counts the rows of a key, its ``id``, the ``size``
    of its text in bytes, its ``tokens`` (the end after them) as 16-bit numbers by the first of ``tables``, and of its frequent
    words how many are ``known``, the sum ``logs`` of the second of ``tables`` and ``outside``, that of the third.
    """
    id_type = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, (token_of, *sums) = Codes(words.value), tables.value
        names = ["word", "bucket", "key", "n", "train", "id", "size", "tokens", "known", "logs", "outside"]
        for batch in batches:
            for start, stop in text_groups(batch.column(3)):
                part = batch.slice(start, stop - start)
                train = pa.array(~part.column(2).to_numpy(zero_copy_only=False).astype(bool))
                code_of, counts, distinct, place = codes.places(part.column(3))
                code, ends = code_of[place], np.cumsum(counts)
                # each document is followed by the end
                data = pa.py_buffer(np.insert(token_of[code], ends, 0))
                cuts = pa.py_buffer(np.r_[0, 2 * (ends + np.arange(1, len(ends) + 1))])
                tokens = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, cuts, data]).cast(pa.binary())
                common = code < codes.fixed
                known, *logs = (np.diff(np.r_[0, np.cumsum(v)][np.r_[0, ends]]) for v in (common.astype(np.int64), *(t[code] for t in sums)))
                none = [pa.nulls(len(ends), kind) for kind in (pa.int64(), pa.int32())]
                document = [part.column(1), pa.array(np.ones(len(ends), np.int64)), train, part.column(0)]
                own = [pc.binary_length(part.column(3)).cast(pa.int64()), tokens, *map(pa.array, (known, *logs))]
                yield pa.RecordBatch.from_arrays([*none, *document, *own], names=names)
                # a number for each pair of a document and a rare word in it
                row = np.repeat(np.arange(part.num_rows), counts)
                rare = ~common
                pairs = row[rare] * len(distinct) + place[rare]
                pairs.sort()
                first = np.flatnonzero(np.r_[len(pairs) > 0, pairs[1:] != pairs[:-1]][: len(pairs)])
                n = np.diff(np.r_[first, len(pairs)])
                row, word = np.divmod(pairs[first], max(len(distinct), 1))
                needed = np.flatnonzero(code_of >= codes.fixed)
                hashes = np.zeros(len(distinct), np.uint64)
                hashes[needed] = np.fromiter(map(xxhash.xxh64_intdigest, distinct.take(pa.array(needed)).to_pylist()), np.uint64, len(needed))
                at = pa.array(row)
                pair = [hashes[word].view(np.int64), code_of[word] - codes.fixed, part.column(1).take(at), n, train.take(at)]
                none = [pa.nulls(len(at), column.type) for column in (part.column(0), *own)]
                yield pa.RecordBatch.from_arrays([*(c if isinstance(c, pa.Array) else pa.array(c) for c in pair), *none], names=names)

    schema = f"word long, bucket int, key long, n long, train boolean, id {id_type}, size long, tokens binary, known long, logs double, outside double"
    return stage(rows.select("id", "key", "held_out", "text").mapInArrow(count, schema), "lm-counts")


def _tokens(column: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The network's tokens of all documents of a staged column, one after the other, and where documents begin and end."""
    column = column.cast(pa.large_binary())
    cuts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    staged = np.frombuffer(column.buffers()[2], np.uint8)[cuts[0] : cuts[-1]].view(np.int16)
    return place.take(staged), (cuts - cuts[0]) // 2


def gradient_round(key: Column) -> Column:
    """The round whose gradients read a training document of this key."""
    return F.pmod(F.xxhash64(key, F.lit("gradient")), F.lit(GRADIENT_SHARE * ROUNDS))


def _fit(docs: DataFrame, table, counts: np.ndarray) -> Gru:
    """Rounds of local training in every partition of the staged documents, each followed by the average weighted by tokens."""
    model = Gru.start(counts)
    context = docs.sparkSession.sparkContext
    for number in range(ROUNDS):
        weights = context.broadcast(model.flat.copy())

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            local = Gru(weights.value.copy())
            squares = np.full(len(local.flat), 1e-6, np.float32)
            tokens, pending, waiting = 0, [], 0
            for batch in (b for b in batches if b.num_rows):
                stream, cuts = _tokens(batch.column(0), table.value)
                for start, stop in size_groups(batch.column(1).to_numpy()):
                    pending.append(stream[cuts[start] : cuts[stop]])
                    waiting += len(pending[-1])
                    if waiting >= 1 << 16:
                        local.train(np.concatenate(pending), squares)
                        tokens, pending, waiting = tokens + waiting, [], 0
            if waiting:
                local.train(np.concatenate(pending), squares)
                tokens += waiting
            if tokens:
                total = (local.flat.astype(np.float64) * tokens).tobytes()
                yield pa.RecordBatch.from_pydict({"weights": pa.array([total], pa.binary()), "tokens": [tokens]})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, tokens = None, 0
            for batch in batches:
                for value, n in zip(batch.column(0), batch.column(1).to_pylist()):
                    part = np.frombuffer(value.as_py())
                    total, tokens = part if total is None else total + part, tokens + n
            if tokens:
                yield pa.RecordBatch.from_pydict({"weights": pa.array([total.tobytes()], pa.binary()), "tokens": [tokens]})

        share = gradient_round(F.col("key")) == number
        schema = "weights binary, tokens long"
        local = docs.where(F.col("train") & share).select("tokens", "size").mapInArrow(train, schema)
        # partial sums in a few tasks, so that the driver adds a fixed number of them
        parts = local.repartition(16, F.spark_partition_id()).mapInArrow(add, schema).collect()
        if parts:
            total = sum(np.frombuffer(p["weights"]) for p in parts) / sum(p["tokens"] for p in parts)
            model = Gru(total.astype(np.float32))
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Tokens are words, lower-cased in A-Z, and one end per document. Counts cover all rows not held out. Frequent
    words are counted in place; the others go by hash once to their word, where the count is known, and once back to their
    document as sums, so no vocabulary is broadcast but the frequent words, whose number is a parameter. The network
    knows the most frequent words and classes of the others by their last characters; within such a class a word has its
    smoothed share of the class. Gradients come from one pass over all training documents, in local passes over
    disjoint parts whose weights are averaged. A document's score is over all of its tokens.

    A null or empty text is an end alone; a null id is held out. Rows equal in id and text share a score. Without training
    rows every word is unseen. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col), text).alias("key"),
        is_held_out(F.col(id_col)).alias("held_out"),
        text.alias("text"),
    )
    top = _frequent_counts(rows, FREQUENT)
    words = spark.sparkContext.broadcast([word for word, _ in top])
    frequent = np.array([0, *(n for _, n in top)], np.int64)  # by code; the end's count is that of training rows
    del top

    # the network's tokens: the end, the most frequent words, the buckets; numbered anew once all counts are known
    own = np.arange(1, min(len(words.value), VOCABULARY - 1 - BUCKETS) + 1)
    outside = np.array([bucket(w) for w in words.value], np.int64)
    other = np.arange(1, len(frequent)) > len(own)
    staged = np.r_[np.arange(len(frequent)), len(own) + 1 + np.arange(BUCKETS)]  # by code
    staged[1 : len(frequent)][other] = len(own) + 1 + outside[other]
    log_count = np.r_[0, np.log10(frequent[1:] + SMOOTHING), np.zeros(BUCKETS)]
    log_outside = np.where(np.r_[False, other, np.zeros(BUCKETS, bool)], log_count, 0.0)
    counted = _counts(rows, words, spark.sparkContext.broadcast((staged.astype(np.int16), log_count, log_outside)))
    documents = counted.where("tokens IS NOT NULL")
    frequent[0] = documents.where("train").count()

    of_word = Window.partitionBy("word")
    count = F.coalesce(F.sum(F.when(F.col("train"), F.col("n"))).over(of_word), F.lit(0))
    share = F.lit(1.0) / F.count("*").over(of_word)  # a word's rows add up to one
    known = counted.where("word IS NOT NULL").select("key", "bucket", "n", count.alias("c"), share.alias("share"), "train")
    sums = stage(
        known.groupingSets([["key"], ["bucket"]], "key", "bucket").agg(
            F.sum(F.col("n") * F.log10(F.col("c") + SMOOTHING)).alias("logs"),
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
            F.round(F.sum(F.when(F.col("c") > 0, F.col("share")).otherwise(0))).alias("types"),
            F.sum(F.when(F.col("train"), F.col("n")).otherwise(0)).alias("tokens"),
        ),
        "lm-rare",
    )
    rare_tokens, rare_types = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums.where("bucket IS NOT NULL").collect():
        rare_tokens[r["bucket"]], rare_types[r["bucket"]] = r["tokens"], r["types"]

    # tokens sorted by count into classes
    bucket_tokens = rare_tokens + np.bincount(outside[other], frequent[1:][other], BUCKETS)
    bucket_types = rare_types + np.bincount(outside[other], minlength=BUCKETS)
    ranked = np.r_[frequent[own], bucket_tokens]
    place = np.zeros(len(ranked) + 1, np.int16)  # by staged token; the end stays 0
    place[1 + np.argsort(-ranked, kind="stable")] = np.arange(1, len(ranked) + 1)
    token_counts = np.zeros(VOCABULARY)
    token_counts[0] = frequent[0]
    token_counts[place[1:]] = ranked

    n_train, n_types = int(frequent.sum() + rare_tokens.sum()), int((frequent > 0).sum() + rare_types.sum())
    # of a word outside the network's vocabulary, what its class's probability is multiplied by, without its count's log
    inner = np.zeros(VOCABULARY)
    inner[place[1 + len(own) :]] = -np.log10(bucket_tokens + SMOOTHING * (bucket_types + 1))

    table = spark.sparkContext.broadcast(place)
    model = _fit(documents, table, token_counts)
    shared = spark.sparkContext.broadcast((model.flat, inner))
    end_log, end_known = float(np.log10(frequent[0] + SMOOTHING)), int(frequent[0] > 0)
    all_log = float(np.log10(n_train + SMOOTHING * (n_types + 1)))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, within = shared.value
        net = Gru(flat)
        for batch in (b for b in batches if b.num_rows):
            tokens, cuts = _tokens(batch.column(3), table.value)
            log10 = net.score([d[:-1] for d in np.split(tokens, cuts[1:-1])]) / np.log(10)
            inside = np.diff(np.r_[0, np.cumsum(within[tokens])][cuts])
            n, (known, logs, outside) = np.diff(cuts), (batch.column(i).to_numpy() for i in (4, 5, 6))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(n, pa.int64()),
                    pa.array(known + end_known),
                    pa.array(logs + end_log - n * all_log),
                    pa.array(log10 + inside + outside),
                ],
                names=["id", "key", "train", "n_tokens", "n_known", "base_score", "score"],
            )

    schema = f"id {id_type}, key long, train boolean, n_tokens long, n_known long, base_score double, score double"
    scored = documents.select("id", "key", "train", "tokens", "known", "logs", "outside").mapInArrow(run, schema)
    # rows of one key are equal in id and text: their sums hold each of them
    copies = documents.groupBy("key").agg(F.sum("n").alias("rows"))
    rare = sums.where("key IS NOT NULL").join(copies, "key").select(
        "key", (F.col("logs") / F.col("rows")).alias("logs"), (F.col("known") / F.col("rows")).cast("long").alias("known")
    )
    logs, known_rare = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return scored.join(rare, "key", "left").select(
        "id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + known_rare).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
