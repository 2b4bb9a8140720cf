import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folio.llm import token_planes
from folio.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return token_planes.WordEncoder(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85\xa0 '<|>ΣŜé̈")), max_size=60))
def test_words_encode_as_the_whole_text(tokenizer, encoder, text):
    assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1'.,!#<|>&\x00\x7fAé ́s", max_size=40))
def test_ascii_pieces_encode_as_the_whole_text(tokenizer, encoder, text):
    assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["it's I'll they're 12 3rd", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "ha😂ha 😂 X 😂😂", "Kelvin K é", "w" * 200, "don't\x0bdo!!! ???", "ΌΔΟΣ ΟΔΟΣ. İstanbul ǅ", ""])
def test_odd_words(tokenizer, encoder, text):
    assert [x.tolist() for x in encoder.encode(pa.array(["", text, ""]))] == [[], tokenizer.encode(text, add_special_tokens=False).ids, []]


@pytest.mark.parametrize("planes", [16, 32])
@pytest.mark.parametrize("count", [1, 7, 8, 1000])
def test_planes_round_trip(planes, count):
    ids = np.random.default_rng(count).integers(0, 1 << min(planes, 31), count).astype(f"<u{planes // 8}")
    rows = token_planes.to_planes(ids, planes)
    assert len(rows) == planes and token_planes.from_planes(rows, count).tolist() == ids.tolist()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_file_round_trip():
    rng = random.Random(2)
    docs = [(i if i % 5 else None, np.array([rng.randint(0, 49000) for _ in range(n)], "<u2")) for i, n in enumerate([1, 0, 3, 700, 64, 65, 1, 128])]
    sink = io.BytesIO()
    writer = token_planes.PlaneWriter(sink, 16, block=64)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = token_planes.PlaneReader(Source(sink.getvalue()))
    everything = np.concatenate([d for _, d in docs])
    assert np.concatenate([reader.read_block(i) for i in range(len(reader.offsets))]).tolist() == everything.tolist()
    assert reader.read_block(3).tolist() == everything[192:256].tolist()
    assert reader.checksums() == [zlib.crc32(d.astype("<u4").tobytes()) for _, d in docs]
    assert [None if m else i for i, m in zip(reader.doc_ids.tolist(), reader.missing)] == [i for i, _ in docs]
    with pytest.raises(ValueError):
        token_planes.PlaneReader(Source(sink.getvalue()[:-3]))


def test_documents_in_order_over_files(spark, tokenizer, tmp_path):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "Gamma", "12", "né"]) for _ in range(rng.randint(0, 400))) for i in rng.sample(range(-50, 1000), 200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    files = token_planes.write_tokens(docs, str(tmp_path / "out"), tokenizer_path(), block=256)
    got = sorted(token_planes.read_documents(files).collect(), key=lambda r: r["id"])
    assert len(list((tmp_path / "out").iterdir())) == files.count() and [r["id"] for r in got] == sorted(texts)
    start = 0
    for r in got:
        ids = tokenizer.encode(texts[r["id"]], add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
