import zlib

import numpy as np
import pytest

from docweave.llm import bitpack
from docweave.llm.shared import parked


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 20, 31, 32])
def test_packing_round_trip_and_ranges(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000).astype(np.uint32)
    packed = bitpack.pack(ids, bits)
    assert len(packed) == -(-1000 * bits // 8)
    assert (bitpack.unpack(packed, bits, 0, 1000) == ids).all()
    for start, count in ((0, 1), (333, 100), (999, 1), (5, 0)):
        assert (bitpack.unpack(packed, bits, start, count) == ids[start:start + count]).all()


def test_bits():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def tokens_of(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bitpack.default_vocabulary())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, bitpack.END_ID]


@pytest.mark.parametrize("text", [
    "Hello World x  it's <|endoftext|>foo İi ́a", "ΑΣ ΑΣ. ＡＢＣ １２3 日本 'll'd", "a\x85b\x1cc", "", " \n ",
    "Naïve café's ÉTÉ œuvre ×÷ ªº µ it'll WE'RE 2024 x--y ...!? {a:'b'} <|x|> 'S don't",
])
def test_words_encode_as_whole_texts(text):
    found = bitpack.WordEncoder(bitpack.default_vocabulary()).encode([text])[0]
    assert np.frombuffer(found, "<u4").tolist() == tokens_of(text)[:-1]


def test_forgotten_words_encode_alike(monkeypatch):
    texts = [" ".join(f"word{i * j}x é{i}!" for j in range(9)) for i in range(40)]
    whole = bitpack.WordEncoder(bitpack.default_vocabulary()).encode(texts)
    monkeypatch.setattr(bitpack, "CACHED_WORDS", 20)
    encoder = bitpack.WordEncoder(bitpack.default_vocabulary())
    assert [encoder.encode([t])[0] for t in texts] == whole == [np.array(tokens_of(t)[:-1], "<u4").tobytes() for t in texts]


def brute_force(rows):
    """Documents in order, with the ids of all before them."""
    ids = {text: tokens_of(text) for _, text, *_ in rows}
    return {d: sorted(len(ids[t]) for e, t, *_ in rows if e == d) for d, *_ in rows}, ids


def test_files_match_brute_force(docs, rows):
    found = bitpack.written_and_read(docs, bitpack.default_vocabulary()).collect()
    sizes, ids = brute_force(rows)
    assert len(found) == len(rows)
    start = 0
    for doc_id in sorted(sizes, key=lambda d: (d is not None, d or 0)):
        held = sorted((r for r in found if r.doc_id == doc_id), key=lambda r: (r.start, r.n_tokens))
        assert sorted(r.n_tokens for r in held) == sizes[doc_id]
        for row in held:
            assert row.start == start
            start += row.n_tokens
    sums = {(d, zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t, *_ in rows}
    assert {(r.doc_id, r.ids_crc32) for r in found} == sums


def test_small_blocks_and_random_access(spark, docs, rows):
    written = parked(bitpack.blocks(docs, bitpack.default_vocabulary(), block_ids=64), "ids")
    assert written.count() > 20
    wanted = spark.createDataFrame([(0,), (60,), (1003,)], "doc_id long")
    _, ids = brute_force(rows)
    texts = {d: t for d, t, *_ in rows}
    found = {r.doc_id: r.ids for r in bitpack.read_ids(written, wanted).collect()}
    assert found == {d: ids[texts[d]] for d in (0, 60, 1003)}


def test_empty_table(no_docs):
    assert bitpack.written_and_read(no_docs, bitpack.default_vocabulary()).count() == 0
