"""Merkle manifest of a document table by nested-interval labels.

Every row is a leaf. Leaves of one language, in ``doc_id`` order, are folded eight at a time into
parents until one node, the language's subroot, is left; subroots, in language order, are folded the
same way into the root. Every node carries the interval ``[lo, hi)`` of global leaf ranks it covers
(languages in order, then rank inside the language), so:

* parents are made level by level, one aggregation per level over ``(scope, idx div 8)``, which no
  hot language can skew (a group never holds more than eight rows);
* each node attaches its parent by a containment join bucketed by level (equal scope and parent
  index, ``parent.lo <= lo`` and ``hi <= parent.hi``), from the root downwards, and inherits the
  parent's chain of siblings;
* its siblings are the interval difference within the parent: the parent's children whose interval
  ends at or before ``lo`` (left) or starts at or after ``hi`` (right).

A leaf's proof is then the concatenation of its chain; folding a (possibly tampered) leaf up the
chain with the original siblings recomputes the root.

Defined cases: a null field is written ``-``; a null ``doc_id`` sorts first in its language, a null
``lang`` first among languages (Spark's byte order of UTF-8 is the order of languages); repeated
rows are separate leaves with equal digests; a language of one row has that leaf as its subroot and
an empty table gives an empty result. Columns other than the five fields are ignored, so clashing
names do not matter. ``doc_id`` and ``n_chars`` are written as decimal integers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.operators.ranking import staged_rank
from folio.session import stage

# fixed values of the manifest: fan-out, fields of a leaf in hashing order, the null mark
ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NULL_MARK = "-"

_SHIFT = ARITY.bit_length() - 1
_CHAIN = "array<struct<before:string,after:string>>"


def field_part(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit(NULL_MARK)).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_part(v) for v in values]), 256)


def _depth(count: Column) -> Column:
    """Levels of folding that ``count`` nodes need: the number of k with 8^k < count."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(21)), lambda k: F.pow(F.lit(ARITY), k) < count)).cast("int")


def _rise(nodes: DataFrame, scope: Sequence[str]) -> DataFrame:
    """The next level: every run of eight nodes (the last one may be shorter) of a scope that still has several."""
    kids = F.sort_array(F.collect_list(F.struct("idx", "lo", "hi", "digest")))
    return (
        nodes.where(F.col("depth") > F.col("level"))
        .groupBy(*scope, "depth", "level", F.shiftright("idx", _SHIFT).alias("pidx"))
        .agg(kids.alias("kids"))
        .select(
            *scope,
            "depth",
            (F.col("level") + 1).alias("level"),
            F.col("pidx").alias("idx"),
            F.col("kids")[0]["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.col("kids.digest"), ""), 256).alias("digest"),
            "kids",
        )
    )


def _attach_parent(children: DataFrame, parents: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Containment join of a level with the level above; the chain grows by the siblings inside the parent."""
    p = parents.select(
        *[F.col(c).alias(f"__p_{c}") for c in scope],
        F.col("idx").alias("__p_idx"),
        F.col("lo").alias("__p_lo"),
        F.col("hi").alias("__p_hi"),
        F.col("kids").alias("__p_kids"),
        F.col("chain").alias("__p_chain"),
    )
    condition = [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in scope] + [
        F.shiftright("idx", _SHIFT) == F.col("__p_idx"),
        F.col("__p_lo") <= F.col("lo"),
        F.col("hi") <= F.col("__p_hi"),
    ]
    digests = lambda keep: F.array_join(F.transform(F.filter("__p_kids", keep), lambda k: k["digest"]), "")
    entry = F.struct(
        digests(lambda k: k["hi"] <= F.col("lo")).alias("before"),
        digests(lambda k: k["lo"] >= F.col("hi")).alias("after"),
    )
    return children.join(p, condition).withColumn("chain", F.concat(F.array(entry), "__p_chain")).drop(*p.columns)


def _tree(level0: DataFrame, scope: Sequence[str], name: str) -> list[DataFrame]:
    """Levels 0, 1, ... of the trees of all scopes; each level is written once."""
    top = level0.agg(F.max("depth")).first()[0] or 0
    levels = [level0]
    for level in range(top):
        levels.append(stage(_rise(levels[-1], scope), f"{name}-up{level + 1}"))
    return levels


def _chains(levels: list[DataFrame], scope: Sequence[str], tops: DataFrame | None, name: str) -> DataFrame:
    """Every node of level 0 with its chain of siblings up to the root.

    ``tops`` holds the chain of every scope's top node (its ``lang`` picks it); without it a top node's chain is empty.
    """
    carried: DataFrame | None = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        at_top = nodes.where(F.col("depth") == level)
        if tops is None:
            at_top = at_top.withColumn("chain", F.expr(f"cast(array() as {_CHAIN})"))
        else:
            t = tops.select(F.col("lang").alias("__t_lang"), F.col("chain"))
            at_top = at_top.join(t, F.col("lang").eqNullSafe(F.col("__t_lang"))).drop("__t_lang")
        if carried is not None:
            below = _attach_parent(nodes.where(F.col("depth") > level), carried, scope)
            at_top = at_top.unionByName(below)
        carried = at_top if level == 0 else stage(at_top, f"{name}-down{level}")
    return carried


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``tampered_text`` (an expression over ``docs``) replaces the text for the folded root; the other
    digests always describe the rows as given. ``verified`` says whether the folded root is the root.
    """
    fields = [F.col(f) for f in FIELDS]
    changed = [tampered_text if f == "text" else F.col(f) for f in FIELDS] if tampered_text is not None else fields
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("lang").alias("lang"),
        leaf_digest(fields).alias("leaf"),
        leaf_digest(changed).alias("tleaf"),
    )
    ranked = staged_rank(rows, ["lang"], ["doc_id", "leaf"], name="rank")
    langs = ranked.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # one row per language: the order of languages and their offsets among all leaves
    in_order = Window.orderBy(F.col("lang").asc_nulls_first())
    langs = stage(
        langs.select(
            "lang",
            "n",
            _depth(F.col("n")).alias("depth"),
            (F.row_number().over(in_order) - 1).cast("long").alias("j"),
            (F.sum("n").over(in_order) - F.col("n")).alias("offset"),
        ),
        "merkle-langs",
    )
    leaves = ranked.join(langs.withColumnRenamed("lang", "__l"), F.col("lang").eqNullSafe(F.col("__l")))
    leaves = leaves.select(
        "doc_id",
        "lang",
        "tleaf",
        "depth",
        F.lit(0).alias("level"),
        (F.col("rank") - 1).alias("idx"),
        (F.col("offset") + F.col("rank") - 1).alias("lo"),
        (F.col("offset") + F.col("rank")).alias("hi"),
        F.col("leaf").alias("digest"),
    )
    levels = _tree(stage(leaves, "merkle-leaves"), ["lang"], "merkle-lang")
    subroots = levels[0].where(F.col("depth") == 0).select("lang", "digest")
    for level, nodes in enumerate(levels[1:], start=1):
        subroots = subroots.unionByName(nodes.where(F.col("depth") == level).select("lang", "digest"))
    n_langs = langs.count()
    top0 = subroots.join(langs.withColumnRenamed("lang", "__l"), F.col("lang").eqNullSafe(F.col("__l")))
    top0 = stage(
        top0.select(
            F.lit(0).alias("__top"),
            "lang",
            F.lit(n_langs).cast("long").alias("__m"),
            F.lit(0).alias("level"),
            F.col("j").alias("idx"),
            F.col("offset").alias("lo"),
            (F.col("offset") + F.col("n")).alias("hi"),
            "digest",
        ).withColumn("depth", _depth(F.col("__m"))).drop("__m"),
        "merkle-subroots",
    )
    top_levels = _tree(top0, ["__top"], "merkle-top")
    root_row = top_levels[-1].where(F.col("depth") == F.col("level")).select("digest").first()
    root = root_row[0] if root_row else None
    top_chains = _chains(top_levels, ["__top"], None, "merkle-top")
    chained = _chains(levels, ["lang"], top_chains, "merkle-lang")
    proof = F.aggregate("chain", F.lit(""), lambda acc, e: F.concat(acc, e["before"], e["after"]))
    folded = F.aggregate("chain", F.col("tleaf"), lambda acc, e: F.sha2(F.concat(e["before"], acc, e["after"]), 256))
    out = chained.join(
        top0.select(F.col("lang").alias("__l"), F.col("digest").alias("subroot")), F.col("lang").eqNullSafe(F.col("__l"))
    )
    return out.select(
        "doc_id",
        "lang",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.lit(root)).alias("verified"),
    )


def lower_ascii(text: Column) -> Column:
    """Only A-Z lower-cased; null stays null."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
