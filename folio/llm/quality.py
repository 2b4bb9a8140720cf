"""Quality rules as a short-circuit cascade in the order of rejection per cost."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

# Cost and selectivity are estimated on about this many rows, drawn by a hash of the text.
SAMPLE_ROWS = 2000


class Text:
    """One text with its measures, each computed when first asked for and then kept."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes split at exactly \x20 and \x09-\x0D

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points that are not white space."""
        blank = sum(self.data.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        return len(self.data.decode("utf-8", "replace")) - blank

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def ids(self) -> np.ndarray:
        """Words as numbers in order of first appearance."""
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 5-word windows that the text holds at least twice."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        kinds = int(self.ids.max()) + 1
        if kinds == self.n_words:
            return 0
        code, width = self.ids[:n], kinds
        for i in range(1, WINDOW):
            if width * kinds >= 1 << 62:
                code = np.unique(code, return_inverse=True)[1]
                width = int(code.max()) + 1
            code, width = code * kinds + self.ids[i : i + n], width * kinds
        _, which, count = np.unique(code, return_inverse=True, return_counts=True)
        twice = count[which] > 1
        edges = np.zeros(self.n_words + 1, np.int64)
        edges[:n] += twice
        edges[WINDOW : WINDOW + n] -= twice
        return int((np.cumsum(edges[:-1]) > 0).sum())

    @cached_property
    def n_echoes(self) -> int:
        """Words equal to the word before them."""
        return int((self.ids[1:] == self.ids[:-1]).sum())

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    @cached_property
    def top_count(self) -> int:
        return int(np.bincount(self.ids).max()) if self.n_words else 0


Rule = tuple[str, Callable[[Text], bool]]

# Each says what it rejects. The first two are the base rules.
RULES: tuple[Rule, ...] = (
    ("too_short", lambda t: t.n_words < MIN_WORDS),
    ("repeats", lambda t: 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words),
    ("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    ("duplicate_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    ("echoes", lambda t: 10 * t.n_echoes > 3 * t.n_words),
    ("capitals", lambda t: 10 * t.n_upper > 3 * t.word_chars),
    ("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 14 * t.n_words),
    ("one_word", lambda t: t.n_words >= 50 and 4 * t.top_count > t.n_words),
)


def rejected_by(text: Text, rules: Sequence[Rule]) -> str | None:
    """The first rule that rejects the text; the later ones are not evaluated."""
    return next((name for name, rejects in rules if rejects(text)), None)


def estimate_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second on a sample, most first.

    Every rule sees every sampled text with nothing computed yet, so its cost is its own. The order decides how much
    work is saved and never what is rejected. An empty table keeps the given order.
    """
    total = docs.count()
    if not total:
        return [name for name, _ in rules]
    draw = F.pmod(F.xxhash64(F.col(text_col), F.lit("sample")), F.lit(1 << 20)) < (sample_rows << 20) // max(total, sample_rows)
    sample = docs.where(draw).select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits = Counter(), Counter()
        for batch in batches:
            for value in batch.column(0):
                data = value.as_py()
                for name, rejects in rules:
                    text, start = Text(data), time.perf_counter()
                    hits[name] += bool(rejects(text))
                    spent[name] += time.perf_counter() - start
        names = [name for name, _ in rules]
        yield pa.RecordBatch.from_pydict(
            {"rule": names, "seconds": [float(spent[n]) for n in names], "hits": [hits[n] for n in names]}
        )

    sums = (
        sample.mapInArrow(measure, "rule string, seconds double, hits long")
        .groupBy("rule")
        .agg(F.sum("seconds").alias("seconds"), F.sum("hits").alias("hits"))
        .collect()
    )
    value = {r["rule"]: (r["hits"] / max(r["seconds"], 1e-9), -r["seconds"]) for r in sums}
    return sorted((name for name, _ in rules), key=lambda name: value.get(name, (0.0, 0.0)), reverse=True)


def cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    order: Sequence[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    measures: bool = False,
) -> DataFrame:
    """``id, kept, rejected_by`` per row, with ``measures`` also the base measures of every text.

    A row is kept if no rule rejects it, whatever the order; ``rejected_by`` is the first rule of the order that did.
    Rows are judged alone, a batch at a time: no shuffle, nothing grows with sources, copies or ties. A null text is
    judged as an empty one (too short), repeated rows are judged alike, null ids stay null, an empty table gives
    no rows, and no other column is read.
    """
    by_name = dict(rules)
    ordered = [(name, by_name[name]) for name in (order or estimate_order(docs, rules, text_col))]
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") if measures else ()
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str | None] = []
            values: dict[str, list[int]] = {c: [] for c in columns}
            for value in batch.column(1):
                text = Text(value.as_py())
                found.append(rejected_by(text, ordered))
                for c in columns:
                    values[c].append(getattr(text, c))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f is None for f in found], pa.bool_()),
                    pa.array(found, pa.string()),
                    *[pa.array(values[c], pa.int64()) for c in columns],
                ],
                names=["id", "kept", "rejected_by", *columns],
            )

    schema = f"id {id_type}, kept boolean, rejected_by string" + "".join(f", {c} long" for c in columns)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return rows.mapInArrow(judge, schema)


def keep_clean(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    order = estimate_order(docs, rules, text_col)
    by_name = dict(rules)
    ordered = [(name, by_name[name]) for name in order]
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (Text((value.as_py() or "").encode()) for value in batch.column(at))
            yield batch.filter(pa.array([rejected_by(t, ordered) is None for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
