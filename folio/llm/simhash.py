"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.components import connected_components
from folio.session import stage

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BITS = 64
# A bucket of more fingerprints than this is compared block against block in tasks of their own.
BLOCK = 4096


def text_fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' hashes; 0 for a text without words."""
    words = data.lower().split()  # both act on ASCII only: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    n = len(words) - shingle + 1
    grams = [b" ".join(words)] if n < 1 else [b" ".join(words[i : i + shingle]) for i in range(n)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 14):  # bounded memory for very long texts
        part = hashes[start : start + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, fp``: the 64 bits as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((text_fingerprint(v.as_py(), shingle) for v in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return rows.mapInArrow(compute, f"id {id_type}, fp long")


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """``first bit, width`` of the segments: just enough that one of them differs by at most one bit.

    With s segments and at most d differing bits some segment has at most floor(d / s), which is 1 from
    s = floor(d / 2) + 1 on.
    """
    count = max_bits // 2 + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``slot, key, fp``: per segment and wildcard position, the segment with that bit cleared."""
    masks = []
    for first, width in segments(max_bits):
        whole = ((1 << width) - 1) << first
        masks += [whole & ~(1 << bit) for bit in range(first, first + width)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return fps.select("fp", F.posexplode(F.lit(signed)).alias("slot", "mask")).select(
        "slot", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted unsigned, as a signed count is that of the absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


class _Forest:
    """Union-find over the positions of one array."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within ``max_bits``, a slice of ``a`` at a time; none when either side is empty."""
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    step = max(1, (1 << 21) // max(len(b), 1))
    for start in range(0, len(a), step):
        x, y = np.nonzero(_distance(a[start : start + step, None], b[None, :]) <= max_bits)
        left.append(x + start)
        right.append(y)
    return np.concatenate(left), np.concatenate(right)


def bucket_links(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect exactly what the pairs within ``max_bits`` connect: one less than its members per component."""
    both = a if b is None else np.concatenate([a, b])
    forest, offset = _Forest(len(both)), 0 if b is None else len(a)
    kept = []
    for i, j in zip(*_near(a, a if b is None else b, max_bits)):
        if (b is not None or i < j) and forest.join(int(i), int(j) + offset):
            kept.append((int(i), int(j) + offset))
    return [(int(both[i]), int(both[j])) for i, j in kept]


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``src, dst``: links between distinct fingerprints with the components of "at most ``max_bits`` bits apart".

    Two fingerprints within the limit share a variant key. The keys are sorted; a bucket is verified where it lies, as
    arrays, and gives a spanning forest of its true pairs: never more links than members, so a dense group of
    near copies costs no quadratic output. Buckets above ``block`` members are dealt out as pairs of blocks.
    """
    keyed = variants(fps, max_bits).repartition("slot", "key").sortWithinPartitions("slot", "key", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))

        def settle(slot, key, fp):
            cut = np.flatnonzero((slot[1:] != slot[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(fp)]
            sizes = ends - starts
            src, dst = [], []
            pairs = starts[sizes == 2]
            near = pairs[_distance(fp[pairs], fp[pairs + 1]) <= max_bits]
            src.append(fp[near])
            dst.append(fp[near + 1])
            for s, e in zip(starts[(sizes > 2) & (sizes <= block)], ends[(sizes > 2) & (sizes <= block)]):
                found = bucket_links(fp[s:e], None, max_bits)
                if found:
                    got = np.array(found, np.int64)
                    src.append(got[:, 0])
                    dst.append(got[:, 1])
            src, dst = np.concatenate(src), np.concatenate(dst)
            if len(src):
                none = pa.nulls(len(src), pa.int32())
                yield pa.RecordBatch.from_arrays([none, pa.nulls(len(src), pa.int64()), pa.array(src), pa.array(dst)], names=names)
            for s, e in zip(starts[sizes > block], ends[sizes > block]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[s:e]), pa.array(key[s:e]), pa.array(fp[s:e]), pa.nulls(e - s, pa.int64())], names=names
                )

        for batch in batches:
            slot, key, fp = (
                np.concatenate([kept, batch.column(i).to_numpy()]) for i, kept in enumerate(carry)
            )
            if not len(fp):
                continue
            # the last bucket may go on in the next batch
            earlier = np.flatnonzero((slot != slot[-1]) | (key != key[-1]))
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            if last:
                yield from settle(slot[:last], key[:last], fp[:last])
            carry = (slot[last:], key[last:], fp[last:])
        if len(carry[2]):
            yield from settle(*carry)

    names = ["slot", "key", "src", "dst"]
    found = stage(keyed.mapInArrow(verify, "slot int, key long, src long, dst long"), "simhash-links")
    small = found.where("slot IS NULL").select("src", "dst")
    large = found.where("slot IS NOT NULL").select("slot", "key", F.col("src").alias("fp"))
    if large.isEmpty():
        return small.distinct()

    # every pair of blocks of a large bucket meets in one group
    sizes = large.groupBy("slot", "key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    dealt = large.join(sizes, ["slot", "key"]).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "slot", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp"
    )

    def compare(group: pa.Table) -> pa.Table:
        own, fp = group.column("own").to_numpy(), group.column("fp").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        found = bucket_links(fp[own == low], None if low == high else fp[own == high], max_bits)
        return pa.table({"src": pa.array([f[0] for f in found], pa.int64()), "dst": pa.array([f[1] for f in found], pa.int64())})

    rest = dealt.groupBy("slot", "key", "low", "high").applyInArrow(compare, "src long, dst long")
    return small.union(rest).distinct()


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, component`` per row: component is the smallest id reachable over links of at most ``max_bits`` bits.

    Rows of one fingerprint are one node, so a third of all rows being copies is one node as well. A text without words
    (null or empty) has fingerprint 0 and links like any other. Rows with a null id take part in links; a component
    of such rows only has a null id. Repeated rows repeat in the result; an empty table gives an empty one.
    """
    rows = stage(fingerprints(docs, id_col, text_col), "simhash-rows")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    classes = connected_components(stage(links(nodes.select("fp"), max_bits), "simhash-edges"))
    # a fingerprint without links is a class of its own
    rooted = nodes.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return rows.join(named, "fp").select("id", "fp", "component")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; of rows equal in all columns one stays.

    Only ids are compared with the groups. Whole rows are compared only where an id occurs twice.
    """
    found = stage(near_duplicates(docs, id_col=id_col, text_col=text_col), "simhash-groups")
    as_id = F.col("id").alias(id_col)
    kept = docs.join(found.where("id <> component").select(as_id).distinct(), id_col, "left_anti")
    twice = found.groupBy("id").count().where("count > 1 AND id IS NOT NULL").select(as_id)
    if twice.isEmpty():
        return kept
    return kept.join(twice, id_col, "left_anti").union(kept.join(twice, id_col, "left_semi").dropDuplicates())
