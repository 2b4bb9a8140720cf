"""Substring dedup: shared k-mer seeds, collinear chains, and alignments of the chains."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.tokens import groups, window_hash
from folio.session import stage

K = 8  # words of a seed
SPACING = 8  # of this many k-mers in a row the one of smallest hash is a seed
MIN_WORDS = 50
IDENTITY = 0.8
GAP_COST = 0.05  # per word of either text between two seeds of a chain
MARGIN = 50  # words looked at beyond both ends of a chain: a single seed at one end of a passage of MIN_WORDS reaches the other
JOIN_GAP = 4  # passages this close in a document count as one when their length is judged
BLOCK = 64  # words of a fetched piece of text
FILTER_BITS = 26
CELLS = 1 << 21  # pairs of words compared at once

_NULL = -(1 << 63)


def seed_table(docs: DataFrame, k: int = K, spacing: int = SPACING) -> DataFrame:
    """``seed, id, at, first``: the minimisers of every text; ``first`` at a seed's first place in its text.

    Two texts that share ``k + spacing - 1`` words in a row share a seed there, whatever surrounds them. A text of at least
    ``k`` words has a seed.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch.column(1)):
                hashes = window_hash(group.tokens, list(range(k)))
                chosen = []
                if len(hashes) >= spacing:
                    windows = np.lib.stride_tricks.sliding_window_view(hashes, spacing)
                    inside = np.flatnonzero(group.inside(k + spacing - 1)[: len(windows)])
                    for start in range(0, len(inside), 1 << 16):
                        some = inside[start : start + (1 << 16)]
                        chosen.append(some + windows[some].argmin(1))
                for t in np.flatnonzero((group.counts >= k) & (group.counts < k + spacing - 1)):
                    begin = group.starts[t]
                    chosen.append(begin + hashes[begin : begin + group.counts[t] - k + 1].argmin(keepdims=True))
                if not chosen:
                    continue
                place = np.unique(np.concatenate(chosen))
                order = np.lexsort((place, hashes[place], group.text[place]))
                place = place[order]
                first = np.r_[True, (hashes[place][1:] != hashes[place][:-1]) | (group.text[place][1:] != group.text[place][:-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[place].view(np.int64)),
                        batch.column(0).take(pa.array(group.rows[group.text[place]])),
                        pa.array(group.at[place].astype(np.int32)),
                        pa.array(first),
                    ],
                    names=["seed", "id", "at", "first"],
                )

    return docs.mapInArrow(cut, "seed long, id long, at int, first boolean")


class _PrefixMax:
    """Fenwick tree: largest value, with its owner, among the first positions."""

    def __init__(self, size: int):
        self.best = [(float("-inf"), -1)] * (size + 1)

    def put(self, at: int, value: float, owner: int) -> None:
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, owner)
            at += at & -at

    def get(self, at: int) -> tuple[float, int]:
        top = (float("-inf"), -1)
        while at:
            if self.best[at] > top:
                top = self.best[at]
            at -= at & -at
        return top


def chains(x: np.ndarray, y: np.ndarray, k: int = K, gap_cost: float = GAP_COST) -> list[np.ndarray]:
    """Collinear chains through matches sorted by ``x``, the best first, as arrays of positions in the input.

    A chain gains ``k`` per match and pays ``gap_cost`` per word between matches in either text. As the cost is a sum of
    a term of each end, the best match to go on from is a prefix maximum over ``y``: O(n log n) in all.
    """
    rank = np.unique(y, return_inverse=True)[1] + 1
    tree, scores, back = _PrefixMax(int(rank.max())), [], []
    for i in range(len(x)):
        along = gap_cost * (int(x[i]) + int(y[i]))
        value, owner = tree.get(int(rank[i]) - 1)
        gain = value - along + 2 * k * gap_cost if owner >= 0 else 0.0
        scores.append(k + max(gain, 0.0))
        back.append(owner if gain > 0 else -1)
        tree.put(int(rank[i]), scores[-1] + along, i)
    used, found = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: -scores[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = back[i]
        if links:
            found.append(np.array(links[::-1]))
    return found


def _gap_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence of two short pieces: what an alignment of a gap can match."""
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        diagonal = np.r_[0, row[:-1] + (b == word)]
        row = np.maximum.accumulate(np.maximum(row, diagonal))
    return int(row[-1])


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place within the owner of each cell, for owners of ``counts`` cells."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]


def _slabs(counts: np.ndarray) -> Iterator[slice]:
    """Ranges of owners of at most ``CELLS`` cells together; a larger owner is a range of its own."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + CELLS, "right")), start + 1)
        yield slice(start, stop)
        start = stop


def _reach(words: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
    """Words to extend by along the diagonal and the matches among them: where matches minus twice the mismatches peaks.

    Entry i compares the ``n[i]`` words from ``a[i]`` on with those from ``b[i]`` on, in the direction ``way``.
    """
    reach, matches = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    some = np.flatnonzero(n > 0)
    for part in _slabs(n[some]):
        of = some[part]
        owner, at = _ragged(n[of])
        same = words[a[of][owner] + way * at] == words[b[of][owner] + way * at]
        starts = np.cumsum(n[of]) - n[of]
        score, found = np.cumsum(np.where(same, 1, -2)), np.cumsum(same)
        score -= np.r_[0, score][starts][owner]
        top = np.maximum.reduceat(score, starts)
        peak = np.minimum.reduceat(np.where(score == top[owner], at, len(at)), starts)
        reach[of] = np.where(top > 0, peak + 1, 0)
        matches[of] = np.where(top > 0, found[starts + peak] - np.r_[0, found][starts], 0)
    return reach, matches


def align_chains(
    words: np.ndarray,
    ours: tuple[np.ndarray, np.ndarray],
    theirs: tuple[np.ndarray, np.ndarray],
    sizes: np.ndarray,
    x: np.ndarray,
    y: np.ndarray,
    k: int = K,
) -> tuple[np.ndarray, ...]:
    """``chain, start, end, other start, other end, identity`` of the passages of all chains, in the order of the chains.

    Chain c has ``sizes[c]`` of the matches ``x, y``; its words are ``words[ours[0][c]:ours[1][c]]`` and those of ``theirs``, and
    matches and passages are places in ``words``. Stretches between matches at one distance are compared word by word, others
    by longest common subsequence. Where less than half of a stretch agrees the chain is cut; both ends of a passage
    are extended while that gains. Identity is matched words over the longer of its two sides.
    """
    chain = np.repeat(np.arange(len(sizes)), sizes)
    if not len(chain):
        return (*[np.zeros(0, np.int64)] * 5, np.zeros(0))
    inner = np.flatnonzero(chain[1:] == chain[:-1]) + 1
    dx, dy = x[inner] - x[inner - 1], y[inner] - y[inner - 1]
    matched = np.zeros(len(inner), np.int64)
    straight = np.flatnonzero(dx == dy)
    for part in _slabs(dx[straight]):
        of = straight[part]
        owner, at = _ragged(dx[of])
        before = inner[of] - 1
        same = words[x[before][owner] + at] == words[y[before][owner] + at]
        matched[of] = np.bincount(owner[same], minlength=len(of))
    for i in np.flatnonzero(dx != dy).tolist():
        j = inner[i]
        matched[i] = _gap_matches(words[x[j - 1] : x[j]], words[y[j - 1] : y[j]])
    longer = np.maximum(dx, dy)
    cut = (2 * (matched - k) < longer - k) & (longer > 2 * k)
    begins = np.ones(len(chain), bool)
    begins[inner[~cut]] = False
    first = np.flatnonzero(begins)
    last = np.r_[first[1:], len(chain)] - 1
    gained = np.zeros(len(chain), np.int64)
    gained[inner] = np.where(cut, 0, matched)
    of = chain[first]
    left, left_same = _reach(words, x[first] - 1, y[first] - 1, np.minimum(x[first] - ours[0][of], y[first] - theirs[0][of]), -1)
    x_end, y_end = x[last] + k, y[last] + k
    right, right_same = _reach(words, x_end, y_end, np.minimum(ours[1][of] - x_end, theirs[1][of] - y_end), 1)
    start, end, other, other_end = x[first] - left, x_end + right, y[first] - left, y_end + right
    same = k + np.add.reduceat(gained, first) + left_same + right_same
    return of, start, end, other, other_end, same / np.maximum(end - start, other_end - other)


def align(ours: np.ndarray, theirs: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = K) -> list[tuple[int, int, int, int, float]]:
    """``start, end, other start, other end, identity`` of the passages of one chain of matches between two word arrays."""
    n, both = len(ours), len(ours) + len(theirs)
    bounds = [(np.array([a]), np.array([b])) for a, b in ((0, n), (n, both))]
    found = align_chains(np.concatenate([ours, theirs]), *bounds, np.array([len(x)]), x, y + n, k)
    return [(s, e, t - n, f - n, same) for _, s, e, t, f, same in zip(*(c.tolist() for c in found))]


def settle(of: np.ndarray, start: np.ndarray, end: np.ndarray, min_words: int) -> np.ndarray:
    """Of passages sorted by document and start, those that make up ``min_words`` with the ones that touch them."""
    if not len(of):
        return np.zeros(0, bool)
    lift = np.cumsum(np.r_[0, of[1:] != of[:-1]]) << 33
    start, reached = start + lift, np.maximum.accumulate(end + lift)
    first = np.flatnonzero(np.r_[True, start[1:] > reached[:-1] + JOIN_GAP])
    after = np.r_[first[1:], len(of)]
    return np.repeat(reached[after - 1] - start[first] >= min_words, after - first)


def _whole(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """The batches of an ascending column without nulls as tables that hold all rows of each of their values."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if cut or held and values[-1] != last:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
        last = values[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it, the first row included."""
    differs = np.zeros(len(columns[0]), bool)
    differs[:1] = True
    for values in columns:
        differs[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(differs)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column next to each other, and each row's end among them; a null has none."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes, dtype=np.int64)


def _chained(matches: DataFrame, k: int) -> DataFrame:
    """``id, chain, other, xs, ys``: chains of one seed and more; their alignment decides what they are worth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, 0):
            own, other, x, y = (table.column(i).to_numpy() for i in range(4))
            starts = _changes(own, other)
            found, heads = [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(own)]):
                some = [p + a for p in chains(x[a:b], y[a:b], k)] if b - a > 1 else [np.array([a])]
                found += some
                heads += [a] * len(some)
            heads, place = np.array(heads), np.concatenate(found)
            ends = pa.array(np.r_[0, np.cumsum([len(p) for p in found])].astype(np.int32))
            number = np.arange(len(heads))
            ids = _changes(own[heads])
            number -= np.repeat(ids, np.diff(np.r_[ids, len(heads)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[heads]),
                    pa.array(number.astype(np.int32)),
                    pa.array(other[heads]),
                    pa.ListArray.from_arrays(ends, pa.array(x[place])),
                    pa.ListArray.from_arrays(ends, pa.array(y[place])),
                ],
                names=["id", "chain", "other", "xs", "ys"],
            )

    ordered = matches.repartition("id").sortWithinPartitions("id", "other", "x")
    return ordered.mapInArrow(run, "id long, chain int, other long, xs array<int>, ys array<int>")


def _pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``of, block, words``: the texts of the ids in ``wanted`` (and of few others) in blocks of word hashes.

    Ids pass a bitmap of fixed size first, so that texts without any chain are not split again.
    """
    place = F.pmod(F.xxhash64("of"), F.lit(1 << FILTER_BITS)) + 1
    parts = (
        wanted.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bitmap = bytearray((1 << FILTER_BITS) // 8)
    for row in parts:
        bitmap[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = row["bits"]
    lookup = docs.sparkSession.sparkContext.broadcast(bytes(bitmap))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(lookup.value, np.uint8)
        for batch in batches:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for group in groups(batch.column(1)):
                n = -(-group.counts // BLOCK)
                text = np.repeat(np.arange(len(n)), n)
                number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
                start = group.starts[text] + number * BLOCK
                end = np.minimum(start + BLOCK, group.starts[text] + group.counts[text])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[start, end[-1:]].astype(np.int32)) if len(start) else pa.array([0], pa.int32()),
                    pa.array(group.tokens.astype(np.uint32).view(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(group.rows[text])), pa.array(number.astype(np.int32)), lists],
                    names=["of", "block", "words"],
                )

    position = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    return docs.select("id", "text", position.alias("at")).mapInArrow(cut, "of long, block int, words array<int>")


def shared_passages(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    identity: float = IDENTITY,
    k: int = K,
    spacing: int = SPACING,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, start, end, other, other_start, other_end, identity``: passages that a document of smaller id holds as well.

    Words count without case and without punctuation at their ends. Every seed of a document is matched with the
    first document that holds it (smallest id), so a passage in a third of all rows costs a match per seed and row and never a
    pair of rows. The matches of a document are chained per first document; chains are aligned on the words around
    them, which are fetched in blocks. A passage is given if it agrees in at least the share ``identity`` of its words and
    it makes up, with other passages of the document that touch it, at least ``min_words`` words. What a document shares with
    two earlier ones in turn is thus found although no single chain covers it.

    Null ids count as one document, and so do rows of one id, which are not compared with each other; they are aligned on
    one of their texts. Texts shorter than a seed, empty or null match nothing. An empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    seeds = stage(seed_table(rows, k, spacing), "passage-seeds")
    owners = (
        seeds.where("first")
        .groupBy("seed")
        .agg(F.min("id").alias("other"), F.min_by("at", "id").alias("y"), F.max("id").alias("last"))
        .where("other < last")
        .drop("last")
    )
    matches = seeds.join(owners, "seed").where("id <> other").select("id", "other", F.col("at").alias("x"), "y")
    found = stage(_chained(matches, k), "passage-chains")

    def need(side: int, of: str, xs: str) -> DataFrame:
        first = F.greatest(F.element_at(xs, 1) - MARGIN, F.lit(0))
        last = F.element_at(xs, -1) + k + MARGIN
        blocks = F.sequence(F.floor(first / BLOCK).cast("int"), F.floor(last / BLOCK).cast("int"))
        return found.select("id", "chain", F.lit(side).alias("side"), F.col(of).alias("of"), F.explode(blocks).alias("block"))

    wanted = need(1, "id", "xs").union(need(2, "other", "ys"))
    pieces = _pieces(rows, found.select(F.col("id").alias("of")).union(found.select(F.col("other").alias("of"))))
    # one text per id, also where rows repeat
    pieces = pieces.groupBy("of", "block").agg(F.min("words").alias("words"))
    texts = wanted.join(pieces, ["of", "block"]).select(
        "id", "chain", "side", "block", "words", F.lit(None).cast("long").alias("other"), *[F.lit(None).cast("array<int>").alias(c) for c in ("xs", "ys")]
    )
    heads = found.select(
        "id", "chain", F.lit(0).alias("side"), F.lit(0).alias("block"), F.lit(None).cast("array<int>").alias("words"), "other", "xs", "ys"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, 0):
            own, side, block = (table.column(i).to_numpy() for i in (0, 2, 3))
            words, filled = _lists(table.column(4))
            (x, ends), (y, _) = _lists(table.column(6)), _lists(table.column(7))
            # a chain's rows: its head, our blocks, their blocks
            head = np.flatnonzero(side == 0)
            after = np.r_[head[1:], len(side)]
            middle = head + 1 + np.add.reduceat(side == 1, head, dtype=np.int64)
            sizes = np.diff(np.r_[0, ends[head]])
            filled = np.r_[0, filled]
            ours, theirs = (filled[head + 1], filled[middle]), (filled[middle], filled[after])
            # from places in the texts to places in the fetched words
            block = np.r_[block, 0].astype(np.int64) * BLOCK
            to_x = ours[0] - np.where(middle > head + 1, block[head + 1], 0)
            to_y = theirs[0] - np.where(after > middle, block[middle], 0)
            x, y = x + np.repeat(to_x, sizes), y + np.repeat(to_y, sizes)
            last = np.cumsum(sizes) - 1
            # of rows that share an id, another text may have been fetched
            there = (x[last] + k <= ours[1]) & (y[last] + k <= theirs[1])
            kept = np.flatnonzero(there)
            matches = np.repeat(there, sizes)
            ours, theirs = ([edge[kept] for edge in bounds] for bounds in (ours, theirs))
            of, start, end, t, f, same = align_chains(words, ours, theirs, sizes[kept], x[matches], y[matches], k)
            good = same >= identity
            of, same = kept[of[good]], same[good]
            start, end, t, f = start[good] - to_x[of], end[good] - to_x[of], t[good] - to_y[of], f[good] - to_y[of]
            other = pc.fill_null(table.column(5), 0).to_numpy()[head][of]
            of = own[head][of]
            order = np.lexsort((same, f, t, other, end, start, of))
            order = order[settle(of[order], start[order], end[order], min_words)]
            if len(order):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[order]) for c in (of, start, end, other, t, f, same)],
                    names=["id", "start", "end", "other", "other_start", "other_end", "identity"],
                )

    ordered = heads.unionByName(texts).repartition("id").sortWithinPartitions("id", "chain", "side", "block")
    schema = "id long, start long, end long, other long, other_start long, other_end long, identity double"
    real = lambda c: F.when(F.col(c) != _NULL, F.col(c)).alias(c)
    return ordered.mapInArrow(verify, schema).select(
        real("id"), "start", "end", real("other"), "other_start", "other_end", "identity"
    )
