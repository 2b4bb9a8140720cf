"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, with the least length of what counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

CANDIDATE = "[A-Za-z0-9+/=_-]{20,}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/=_-"
WINDOW = 20
# Bits that some window of a candidate must reach, by its character class. Random strings of a class
# lie around 3.3, 3.9 and 4.0 bits in a window of 20.
CLASSES = (
    ("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("entropy_upper", r"^[A-Z0-9]+$", 3.5),
    ("entropy_mixed", r"^[A-Za-z0-9+/=_-]+$", 3.8),
)
# Candidates that are no secrets: without a digit or without a letter, identifiers of a known form, runs of the
# alphabet, placeholders, paths and dashed words; and values that their left context calls a checksum.
ALLOWED = (
    r"^[^0-9]+$",
    r"^[^A-Za-z]+$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"(?i)0123456789|abcdefghij|qwertyuiop|example|placeholder|changeme|dummy|xxxxxx",
    r"(.)\1{5}",
)


def path_like(hit: Column) -> Column:
    """Paths and dashed words: after an optional ``/``, runs of 1 to 14 letters or digits joined by single ``/``, ``_`` or
    ``-``, at least two joins. Stated as conditions without a repeated group, which Java's regular expressions
    would follow by recursion, one level a segment, and overflow on a long path."""
    rest = F.regexp_replace(hit, r"^/", "")
    return (
        hit.rlike(r"^/?[A-Za-z0-9][A-Za-z0-9/_-]*$")
        & ~hit.rlike(r"[/_-][/_-]")
        & ~hit.rlike(r"[A-Za-z0-9]{15}")
        & (F.regexp_count(rest, F.lit(r"[/_-]")) >= 2)
    )


ALLOWED_CONTEXT = r"(?i)(?:md5|sha-?\d*|crc\d*|checksum|digest|integrity|commit|uuid)[\x22':=\s-]{0,4}$"
CONTEXT = 24

_SPANS = "array<struct<start:int,end:int,hit:string>>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``start, end, hit`` in code points, end exclusive.

    The pieces between the matches and the matches themselves add up to the positions.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def add(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + F.length(piece["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), piece["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    found = F.aggregate(pieces, start, add, lambda state: state["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def hot_range(value: Column, threshold: Column, window: int = WINDOW) -> Column:
    """``start, end`` covering the windows of at least ``threshold`` bits; start -1 if there are none.

    A window's entropy is log2(w) - sum(n log2 n) / w over its character counts n. Sliding by one
    changes two counts, so each step corrects two of them and two terms of the sum.
    """
    terms = F.lit([0.0] + [n * math.log2(n) for n in range(1, window + 2)])
    term = lambda n: F.get(terms, n)
    index = lambda at: F.instr(F.lit(ALPHABET), F.substring(value, at, F.lit(1)))
    zero = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(-1).alias("start"),
        F.lit(-1).alias("end"),
    )

    def enter(state: Column, at: Column) -> Column:
        new = index(at) - 1
        old = F.when(at > window, index(at - window) - 1).otherwise(F.lit(-1))
        counts = F.transform(
            state["counts"],
            lambda n, i: n + F.when(i == new, 1).otherwise(0) - F.when(i == old, 1).otherwise(0),
        )
        before_new, before_old = F.get(state["counts"], new), F.get(state["counts"], old)
        change = F.when(new == old, F.lit(0.0)).otherwise(
            term(before_new + 1)
            - term(before_new)
            + F.when(old >= 0, term(before_old - 1) - term(before_old)).otherwise(0.0)
        )
        total = state["total"] + change
        hot = (at >= window) & (math.log2(window) - total / window >= threshold - 1e-9)
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(hot & (state["start"] < 0), at - window).otherwise(state["start"]).alias("start"),
            F.when(hot, at).otherwise(state["end"]).alias("end"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.length(value)),
        zero,
        enter,
        lambda state: F.struct(state["start"].alias("start"), state["end"].alias("end")),
    )


def entropy_spans(text: Column) -> Column:
    """``start, end, kind`` of candidates with a window of high entropy that no allow-list rule clears."""
    kept = F.filter(
        located(text, CANDIDATE),
        lambda c: ~(reduce(or_, [c["hit"].rlike(rule) for rule in ALLOWED]) | path_like(c["hit"]))
        & ~F.substring(
            text, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT))
        ).rlike(ALLOWED_CONTEXT),
    )

    def span(c: Column) -> Column:
        kind, bits = F.lit(None).cast("string"), F.lit(99.0)
        for name, pattern, least in reversed(CLASSES):
            kind = F.when(c["hit"].rlike(pattern), name).otherwise(kind)
            bits = F.when(c["hit"].rlike(pattern), least).otherwise(bits)
        hot = hot_range(c["hit"], bits)
        return F.struct(
            (c["start"] + hot["start"]).alias("start"),
            (c["start"] + hot["end"]).alias("end"),
            kind.alias("kind"),
            hot["start"].alias("hot"),
        )

    return F.filter(F.transform(kept, span), lambda s: s["hot"] >= 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` per row; spans: ``start, rank, end, kind`` in order of start, then rank.

    Base kinds (assign, access, hex) come from fixed patterns. The entropy kinds add candidates that
    no base span overlaps. Everything is a column expression on the row, so no row meets another:
    hot sources and copies do not matter, repeated rows repeat, a null or empty text has no spans, an empty table
    gives none, and other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    tag = lambda spans, kind, rank: F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id",
        located(F.col("text"), ASSIGN).alias("assign"),
        located(F.col("text"), ACCESS).alias("access"),
        located(F.col("text"), HEX).alias("hex"),
        entropy_spans(F.col("text")).alias("entropy"),
    )
    long_enough = F.filter(
        "assign", lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= ASSIGN_VALUE
    )
    rows = rows.select(
        "id",
        F.concat(tag(long_enough, "assign", 0), tag(F.col("access"), "access", 1), tag(F.col("hex"), "hex", 2)).alias("base"),
        "entropy",
    )
    added = F.filter(
        "entropy",
        lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (b["end"] > e["start"])),
    )
    as_base = F.transform(
        added, lambda e: F.struct(e["start"].alias("start"), F.lit(3).alias("rank"), e["end"].alias("end"), e["kind"].alias("kind"))
    )
    return rows.select("id", F.array_sort(F.concat("base", as_base)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["rank"] < 3)
    count = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
