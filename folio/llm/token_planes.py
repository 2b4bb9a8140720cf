"""Token ids as binary files of compressed bit planes.

A file holds the ids of a range of documents in blocks of fixed size. A block is transposed to one plane per bit, so that
the nearly constant high bits of all its ids lie together, and each plane is compressed alone. Layout, little-endian:

    magic | planes of block 0, 1, ... | footer (zstandard) | footer length (u64) | magic

The footer is the chunk index: counts (ids a block, planes, blocks, documents, ids), each block's offset, the length of each
of its planes, and each document's id, null flag and number of ids.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.session import scratch_path, stage

MAGIC = b"BITPLNS1"
BLOCK = 1 << 16
LEVEL = 3
END_ID = 2
CACHE_WORDS = 400_000  # in each of two generations
CACHED_LENGTH = 64
GROUP_BYTES = 6 << 20
SEPARATOR = "\U0001f602"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    if ":/" not in path:
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


# Printable ASCII without capitals and apostrophes needs no normalising, and a splitter parts it into letters, single
# digits and runs of other signs: such pieces go to the library's model directly.
PLAIN = re.compile(rb"[!-&(-@\[-~]{1,200}")
PIECES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")


class WordEncoder:
    """Ids of whole texts, with the ids of recent words kept.

    For a tokenizer that ignores case in A-Z and whose normaliser and splitter treat white space as a boundary, the ids of
    a text are those of its words in turn. Words not seen lately go through the library, many at a time with a
    separator between them that encodes as one id of its own; words that hold the separator or a special token go
    through it alone. Two generations of words are kept, the older one goes when the newer is full.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.planes = 16 if self.tokenizer.get_vocab_size() <= 1 << 16 else 32
        self.dtype = np.dtype("<u2" if self.planes == 16 else "<u4")
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.mark = self._ids(SEPARATOR)
        if len(self.mark) != 1 or self._ids(f"a {SEPARATOR} b").tolist() != [*self._ids("a"), *self.mark, *self._ids("b")]:
            raise ValueError("the separator is not a word of one id in this vocabulary")
        for probe in (b"ab12cd", b"end.", b"!?word&;", b"(x)"):
            if self._encode_words([probe])[probe] != self._ids(probe.decode()).tobytes():
                raise ValueError("the vocabulary does not part words at letters, digits and signs")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        out, plain = {}, []
        tokenize, kind = self.tokenizer.model.tokenize, self.dtype
        for word in words:
            if b"<|" not in word and PLAIN.fullmatch(word):
                ids = [token.id for piece in PIECES.findall(word) for token in tokenize(piece.decode())]
                out[word] = np.array(ids, kind).tobytes()
                continue
            text = word.decode("utf-8", "replace")
            if SEPARATOR in text or "<|" in text or len(word) > CACHED_LENGTH:
                out[word] = self._ids(text).tobytes()
            else:
                plain.append((word, text))
        width = self.dtype.itemsize
        for start in range(0, len(plain), 1000):
            part = plain[start : start + 1000]
            ids = self._ids(f" {SEPARATOR} ".join(text for _, text in part))
            data, at = ids.tobytes(), 0
            for (word, _), end in zip(part, [*np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)], strict=True):
                out[word] = data[at * width : end * width]
                at = end + 1
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (strings without nulls). Each distinct word of the array is looked up once."""
        # a special token is spelled in one case: texts with anything like it keep theirs
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lower)
        coded = split.flatten().cast(pa.binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        found = {w: self.older[w] for w in new if w in self.older}
        found |= self._encode_words([w for w in new if w not in found])
        ids = [self.known[w] if w in self.known else found[w] for w in words]
        self.known.update((w, i) for w, i in found.items() if len(w) <= CACHED_LENGTH)
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known

        pool = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // self.dtype.itemsize
        word = coded.indices.to_numpy()
        counts = sizes[word]
        ends = np.cumsum(counts, dtype=np.int64)
        # the ids of word i stand at its place in the pool, moved to where the word begins
        moved = (np.cumsum(sizes, dtype=np.int64) - sizes)[word] - (ends - counts)
        kind = np.int32 if len(pool) + ends[-1:].sum() < 1 << 31 else np.int64
        place = np.repeat(moved.astype(kind), counts)
        place += np.arange(len(place), dtype=kind)
        stream = pool[place]
        last = np.r_[0, ends][np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.split(stream, last[:-1])


@lru_cache(maxsize=2)
def word_encoder(tokenizer_path: str) -> WordEncoder:
    """One encoder per Python worker: later tasks find its words."""
    return WordEncoder(tokenizer_path)


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """One bit string per plane, lowest bit first."""
    width = planes // 8
    bits = np.unpackbits(ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width), axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(rows: list[bytes], count: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    bits = np.unpackbits(packed, axis=1, count=count, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(f"<u{len(rows) // 8}").ravel()


class PlaneWriter:
    """Writes one file; holds one block and the index."""

    def __init__(self, sink, planes: int, block: int = BLOCK, level: int = LEVEL):
        self.sink, self.planes, self.block = sink, planes, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.pending: list[np.ndarray] = []
        self.waiting = self.ids = 0
        self.offsets, self.lengths, self.docs = [], [], []
        self.at = sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.ids += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            data = np.concatenate(self.pending)
            full = len(data) // self.block * self.block
            for start in range(0, full, self.block):
                self._flush(data[start : start + self.block])
            self.pending, self.waiting = [data[full:]], len(data) - full

    def _flush(self, ids: np.ndarray) -> None:
        parts = [self.zstd.compress(p) for p in to_planes(ids, self.planes)]
        self.offsets.append(self.at)
        self.lengths += map(len, parts)
        self.at += self.sink.write(b"".join(parts))

    def close(self) -> None:
        if self.waiting:
            self._flush(np.concatenate(self.pending))
        missing = [d is None for d, _ in self.docs]
        footer = self.zstd.compress(
            b"".join(
                [
                    struct.pack("<5Q", self.block, self.planes, len(self.offsets), len(self.docs), self.ids),
                    np.array(self.offsets, "<u8").tobytes(),
                    np.array(self.lengths, "<u4").tobytes(),
                    np.array([d or 0 for d, _ in self.docs], "<i8").tobytes(),
                    np.array(missing, "u1").tobytes(),
                    np.array([n for _, n in self.docs], "<u8").tobytes(),
                ]
            )
        )
        self.sink.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


class PlaneReader:
    """Reads a file's index, and its blocks one at a time or by number."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 16)
        length, magic = struct.unpack("<Q8s", source.read(16))
        if magic != MAGIC:
            raise ValueError("not a file of bit planes, or not complete")
        source.seek(size - 16 - length)
        footer = zstandard.ZstdDecompressor().decompress(source.read(length))
        self.block, self.planes, n_blocks, n_docs, self.ids = struct.unpack_from("<5Q", footer)
        at = 40

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(footer, kind, count, at)
            at += values.nbytes
            return values

        self.offsets, self.lengths = take("<u8", n_blocks), take("<u4", n_blocks * self.planes).reshape(-1, self.planes)
        self.doc_ids, self.missing, self.counts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)

    def read_block(self, number: int) -> np.ndarray:
        self.source.seek(int(self.offsets[number]))
        data = self.source.read(int(self.lengths[number].sum()))
        rows, at, zstd = [], 0, zstandard.ZstdDecompressor()
        for length in self.lengths[number]:
            rows.append(zstd.decompress(data[at : at + length]))
            at += length
        return from_planes(rows, int(min(self.block, self.ids - number * self.block)))

    def checksums(self) -> list[int]:
        """CRC-32 of every document's ids as u32, block after block."""
        sums, block, at, number = [], np.empty(0, "<u4"), 0, 0
        for count in self.counts:
            left, crc = int(count), 0
            while left:
                if at == len(block):
                    block, at, number = self.read_block(number).astype("<u4"), 0, number + 1
                part = block[at : at + left]
                crc = zlib.crc32(part.tobytes(), crc)
                at += len(part)
                left -= len(part)
            sums.append(crc)
        return sums


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encodes and writes all rows in ascending id order; returns ``part, file, first, docs, ids``, one row per file.

    Rows are range-partitioned and sorted by id (ties by the text's hash and the text, null ids first), so file after file
    holds the ids in order; ``first`` is a file's position among all ids. A task writes under a name of its own and
    only the files of tasks that succeeded are listed, so a lost executor leaves at most an unlisted file. A task holds
    a batch of texts, one block and its index. A null text is an empty one: the end id alone. An empty table
    gives no files.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, sink, target = TaskContext.get().partitionId(), None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, root = open_fs(path)
                system.create_dir(root, recursive=True)
                name = f"part-{part:05d}-{uuid.uuid4().hex}.planes"
                target, sink = f"{path}/{name}", system.open_output_stream(f"{root}/{name}")
                encoder = word_encoder(tokenizer_path)
                end = np.array([end_id], encoder.dtype)
                writer = PlaneWriter(sink, encoder.planes, block)
            ids, texts = batch.column(0), batch.column(1)
            # some megabytes at a time, or one longer text
            part_of = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // GROUP_BYTES
            cuts = np.r_[0, np.flatnonzero(np.diff(part_of)) + 1, batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                for doc_id, found in zip(ids[start:stop], encoder.encode(texts[start:stop])):
                    writer.add(doc_id.as_py(), np.concatenate([found, end]))
            pa.default_memory_pool().release_unused()
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [target], "docs": [len(writer.docs)], "ids": [writer.ids]})

    written = stage(ordered.mapInArrow(write, "part int, file string, docs long, ids long"), "plane-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, from the listed files alone; a task per file, a block at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_encoder.cache_clear()  # the files are complete: no words are kept for whatever the worker does next
        for batch in batches:
            for row in batch.to_pylist():
                system, name = open_fs(row["file"])
                with system.open_input_file(name) as source:
                    reader = PlaneReader(source)
                    sums = reader.checksums()
                counts = reader.counts.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, mask=reader.missing.astype(bool)),
                        pa.array(row["first"] + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    listed = files.select("part", "file", "first")
    spread = listed.repartition(max(files.count(), 1), "part")
    return spread.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Writes the files below ``path`` (by default in the shared scratch folder) and reads every document back."""
    path = path or scratch_path(docs.sparkSession, "token-planes")
    return read_documents(write_tokens(docs, path, tokenizer_path, **options))
