import numpy as np
import pyarrow as pa
import xxhash

from folio.llm import tokens


def plain(word):
    core = word.lower().strip(b".,;:!?\"'()[]{}<>*_`~-") or word
    return xxhash.xxh64_intdigest(core)


TEXTS = [b"", b"  ", b" a B\t", b"\xff\xfeA .x. ... -- 'Q'", "É.é ÀB- z y".encode(), b"..", b"\x1c\x85 q\x0bz\x0c", b"Aa aA (aa)\r\nAA"]


def test_words_are_hashed_without_case_and_outer_punctuation():
    for array in (pa.array(TEXTS), pa.array(TEXTS)[2:7]):
        found, counts = tokens.word_hashes(array)
        words = [v.as_py().split() for v in array]
        assert counts.tolist() == [len(w) for w in words]
        assert found.tolist() == [plain(w) for ws in words for w in ws]


def test_groups_hold_all_texts_in_order_and_no_arrow_memory_afterwards():
    texts = pa.array(TEXTS * 3 + [b"word " * 50] + TEXTS)
    before = pa.total_allocated_bytes()
    for limit in (1, 40, 1 << 20):
        found = list(tokens.groups(texts, limit))
        assert np.concatenate([g.rows for g in found]).tolist() == list(range(len(texts)))
        assert np.concatenate([g.tokens for g in found]).tolist() == [plain(w) for v in texts for w in v.as_py().split()]
        assert np.concatenate([g.counts for g in found]).tolist() == [len(v.as_py().split()) for v in texts]
    del found
    assert pa.total_allocated_bytes() == before
    assert not list(tokens.groups(texts[:0]))
