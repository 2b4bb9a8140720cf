"""Array helpers that stay inside one row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTED_ROWS = 256  # rows whose tokens are coded at once in a task
_BAG = "array<struct<term:string,n:bigint>>"
_BAG_TYPE = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_items(items: Column) -> Column:
    """Distinct items of an array with their counts: ``array<struct<term, n>>``, ordered by term; null for no item.

    The items of a batch get integer codes, which are sorted and measured in runs, so a bag of words costs no shuffle.
    """
    return count_ngrams(items, 1, 1)


def count_ngrams(tokens: Column, lo: int = 1, hi: int = 1) -> Column:
    """``count_items(ngrams(tokens, lo, hi))`` without the strings of repeated n-grams: only the distinct ones of a batch are joined."""

    @F.arrow_udf(_BAG)
    def bags(column: pa.Array) -> pa.Array:
        return counted(column, lo, hi)

    return bags(tokens)


def _flat(tokens: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All tokens one after the other, each one's row, and where its row ends."""
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return tokens.flatten(), np.repeat(np.arange(len(tokens)), lengths), np.repeat(np.cumsum(lengths), lengths)


def counted(tokens: pa.ListArray, lo: int, hi: int) -> pa.ListArray:
    """``count_ngrams`` of an Arrow array, for tasks that hold one."""
    parts = [_count(tokens.slice(at, COUNTED_ROWS), lo, hi) for at in range(0, len(tokens), COUNTED_ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], _BAG_TYPE)


def _count(tokens: pa.ListArray, lo: int, hi: int) -> pa.ListArray:
    flat, row, ends = _flat(tokens)
    coded = flat.dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, ids, names = np.arange(len(codes)), codes, words
    rows, keys, terms, base = [], [], [], 0
    for n in range(1, hi + 1):
        if n > 1:
            inside = at + n - 1 < ends[at]
            at = at[inside]
            pairs = pa.array(ids[inside] * max(len(words), 1) + codes[at + n - 1]).dictionary_encode()
            ids, pair = pairs.indices.to_numpy().astype(np.int64), pairs.dictionary.to_numpy()
            first, last = np.divmod(pair, max(len(words), 1))
            names = pc.binary_join_element_wise(names.take(pa.array(first)), words.take(pa.array(last)), " ")
        if n >= lo:
            rows.append(row[at])
            keys.append(ids + base)
            terms.append(names)
            base += len(names)
    every = pa.concat_arrays(terms)
    order = pc.sort_indices(every).to_numpy()
    ordered = every.take(pa.array(order))
    # equal strings of several lengths (words with blanks) are one term
    begins = np.r_[base > 0, pc.not_equal(ordered[1:], ordered[:-1]).to_numpy(zero_copy_only=False)][:base].astype(bool)
    rank = np.empty(base, dtype=np.int64)
    rank[order] = np.cumsum(begins) - 1
    ordered = ordered.filter(pa.array(begins))
    size = max(len(ordered), 1)
    cells = np.sort(np.concatenate(rows) * size + rank[np.concatenate(keys)])
    starts = np.flatnonzero(np.r_[len(cells) > 0, cells[1:] != cells[:-1]][: len(cells)])
    n = np.diff(np.r_[starts, len(cells)])
    of, term = np.divmod(cells[starts], size)
    found = np.bincount(of, minlength=len(tokens))
    items = pa.StructArray.from_arrays([ordered.take(pa.array(term)), pa.array(n.astype(np.int64))], names=["term", "n"])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(found)].astype(np.int32)), items, mask=pa.array(found == 0))


def ngrams(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """All contiguous n-grams with lo <= n <= hi, joined by one space, the shorter ones first; null for a null array."""
    if lo == hi == 1:
        return tokens

    @F.arrow_udf("array<string>")
    def joined(column: pa.Array) -> pa.Array:
        parts = [_join(column.slice(at, COUNTED_ROWS), lo, hi) for at in range(0, len(column), COUNTED_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return joined(tokens)


def native_ngrams(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """``ngrams`` without Python: for tables whose n-grams are wide next to a worker's memory."""
    if lo == hi == 1:
        return tokens

    def joined(words: Column) -> Column:
        parts = [words] if lo == 1 else []
        for n in range(max(lo, 2), hi + 1):
            longer = [F.slice(words, F.lit(i + 1), F.greatest(F.size(words) - (n - 1), F.lit(0))) for i in range(n)]
            grams = longer[0]
            for more in longer[1:]:
                grams = F.zip_with(grams, more, lambda a, b: F.concat(a, F.lit(" "), b))
            parts.append(grams)
        return F.concat(*parts)

    return let(tokens, joined)


def _join(tokens: pa.ListArray, lo: int, hi: int) -> pa.ListArray:
    flat, row, ends = _flat(tokens)
    at, names = np.arange(len(flat)), flat
    rows, terms = [], []
    for n in range(1, hi + 1):
        if n > 1:
            inside = at + n - 1 < ends[at]
            at = at[inside]
            names = pc.binary_join_element_wise(names.filter(pa.array(inside)), flat.take(pa.array(at + n - 1)), " ")
        if n >= lo:
            rows.append(row[at])
            terms.append(names)
    of = np.concatenate(rows)
    found = np.bincount(of, minlength=len(tokens))
    ordered = pa.concat_arrays(terms).take(pa.array(np.argsort(of, kind="stable")))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(found)].astype(np.int32)), ordered, mask=tokens.is_null())


def l2_norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def normalize_vector(vector: Column) -> Column:
    """L2-normalised copy as ``array<double>``; a zero vector stays zero."""
    return let(
        l2_norm(vector),
        lambda norm: F.transform(
            vector, lambda x: F.when(norm == 0.0, x.cast("double")).otherwise(x.cast("double") / norm)
        ),
    )
