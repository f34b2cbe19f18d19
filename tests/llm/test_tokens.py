from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skylog.llm import bpe, simple8b

ODD = [
    "", "  a  b\n\n c \t\n", "x<|endoftext|> y  <|endoftext|>z", "<|startoftext|>hi there<|endoftext|>", "ΑΣ ΣΑΣ İstanbul é \x1c\x1d a\x85b c",
    "don't I'LL we'Re 's", "日本語 テスト 123 ½ ²", "a" * 3000, "</w> </ w> <w", "🙂🙃 ok﻿", "a\r\n\r\n b", "̀a b́", "ǅ ﬁ ŉ ẞ K Å",
]


@pytest.fixture(scope="module")
def texts(documents):
    return ODD + [r.text for r in documents.select("text").collect()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_pack_round_trip(ids):
    given_ids = np.array(ids, np.uint64)
    words, offsets = simple8b.pack(given_ids)
    assert (simple8b.unpack(words, offsets, len(ids)) == given_ids).all()
    assert len(offsets) == -(-len(ids) // simple8b.BLOCK)


def test_pack_is_dense_and_blocks_stand_alone():
    assert len(simple8b.pack(np.zeros(600, np.uint64))[0]) == 10
    assert len(simple8b.pack(np.full(400, 2**15 - 1, np.uint64))[0]) == 100
    ids = np.arange(5000, dtype=np.uint64)
    words, offsets = simple8b.pack(ids)
    third = simple8b.unpack(words[offsets[2] : offsets[3]], np.array([0], "<u4"), simple8b.BLOCK)
    assert (third == ids[2 * simple8b.BLOCK : 3 * simple8b.BLOCK]).all()


def test_chunks_give_the_ids_of_whole_texts(texts, byte_bpe):
    whole = Tokenizer.from_file(byte_bpe).encode_batch(texts, add_special_tokens=False)
    made = simple8b.TextEncoder(byte_bpe).encode(texts)
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [e.ids for e in whole]


BLOCKS = [
    "", "\n", " \n\n", "a", ", b", "é,à ×, ÷. ñ!", "a  \n", "\n\n b", "x\n\ny \tz\t", "Здравствуй, мир. ҂, Ҁ.", "a,b.c;d 'll. don't. I'm, x'. é'. …, “a”. ²,",
    "a\x85b, c\xa0d", "\u3000", "́, q́. 漢, か.", "<|endoftext|> a, b", "end ", " ", "word.", ". word", "\x1c, a\x1f b", "\x00,a", "ab,", ",",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZéß×÷ЯҁҀ1².,;:!?'s-…“ \n\t\r\x0b\x1c\x85\xa0\u2003漢́🙂\x00"), max_size=14), max_size=6))
def test_blocks_give_the_ids_of_whole_texts(byte_bpe, given_texts):
    encoder = simple8b._encoder(byte_bpe)
    for texts in (given_texts, BLOCKS, BLOCKS[::-1]):
        whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(m, "<u4").tolist() for m in encoder.encode_block(texts)] == [e.ids for e in whole]


def test_a_block_looks_every_chunk_up_once(byte_bpe):
    encoder = simple8b.TextEncoder(byte_bpe)
    asked = []
    encoder.known = type("Known", (dict,), {"__missing__": lambda self, chunk: asked.append(chunk) or encoder._chunk(chunk)})()
    texts = ["some words, some more words. " * 50, "more words", ""]
    made = encoder.encode_block(texts)
    assert sorted(asked) == sorted({"some", " words", ",", " some", " more", ".", " ", "more"})
    assert made == simple8b.TextEncoder(byte_bpe).encode(texts)


def test_long_texts_of_a_block_are_cut_at_chunks(byte_bpe, monkeypatch):
    monkeypatch.setattr("skylog.llm.chunks.PIECE", 50)
    monkeypatch.setattr(simple8b, "PIECE", 50)
    texts = ["short text, " * 4, "It's a  long\n\n text, that's cut " * 200, "short"]
    whole = Tokenizer.from_file(byte_bpe).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(m, "<u4").tolist() for m in simple8b.TextEncoder(byte_bpe).encode_block(texts)] == [e.ids for e in whole]


def test_token_files_of_several_lines_in_a_block(spark, byte_bpe, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text, number {i}.  \n\n" * (i % 4)) for i in range(60)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(simple8b, "LINE", 100)
    simple8b.write_tokens(docs, path := str(tmp_path / "lines"), byte_bpe)
    tokenizer = Tokenizer.from_file(byte_bpe)
    got = {r.doc_id: r.ids for r in simple8b.read_tokens(spark, path).collect()}
    assert got == {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [0] for r in docs.collect()}


def test_long_texts_are_cut_at_chunks(byte_bpe, word_bpe, monkeypatch):
    text = "It's a  long\n\n text, that's cut " * 200
    whole = Tokenizer.from_file(byte_bpe).encode(text, add_special_tokens=False).ids
    words = Tokenizer.from_file(word_bpe).encode(text, add_special_tokens=False).ids
    monkeypatch.setattr("skylog.llm.chunks.PIECE", 50)
    monkeypatch.setattr(bpe, "SLICE", 7)
    assert np.frombuffer(simple8b.TextEncoder(byte_bpe).encode([text])[0], "<u4").tolist() == whole
    tokenizer = bpe.WordTokenizer(word_bpe)
    ids = np.frombuffer(tokenizer.encode([text])[0], "<u4")
    assert ids.tolist() == words
    assert tokenizer.digest(ids, decoded=False) == hashlib.sha256(" ".join(map(str, words)).encode()).hexdigest()


def test_kept_chunks_are_bounded(byte_bpe):
    encoder = simple8b.TextEncoder(byte_bpe)
    encoder.known.kept = 10
    made = [encoder.encode([f"text {i} again text {i % 3}"])[0] for i in range(60)]
    assert len(encoder.known) <= 10 and len(encoder.known.old) <= 10
    assert made[3] == simple8b.TextEncoder(byte_bpe).encode(["text 3 again text 0"])[0]


def test_token_files(spark, edge, byte_bpe, tmp_path):
    path = str(tmp_path / "tokens")
    simple8b.write_tokens(edge, path, byte_bpe)
    tokenizer = Tokenizer.from_file(byte_bpe)
    rows = sorted(((r.doc_id, r.text or "") for r in edge.collect()), key=lambda r: (r[0] is not None, r))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        expected.append((doc_id, start, ids))
        start += len(ids)
    order = lambda r: (r[1])
    assert sorted([(r.doc_id, r.start, r.ids) for r in simple8b.read_tokens(spark, path).collect()], key=order) == expected
    sums = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in simple8b.token_checksums(spark, path).collect()]
    assert sorted(sums, key=order) == [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in expected]


def test_empty_token_file(spark, nothing, byte_bpe, tmp_path):
    path = str(tmp_path / "empty")
    simple8b.write_tokens(nothing, path, byte_bpe)
    assert simple8b.token_checksums(spark, path).count() == 0


def test_backtracking_gives_the_ids_of_merging(texts, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    tokenizer = bpe.WordTokenizer(word_bpe)
    for made, encoded in zip(tokenizer.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        ids = np.frombuffer(made, "<u4")
        assert ids.tolist() == encoded.ids
        assert tokenizer.decode(ids) == library.decode(encoded.ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aàbcehinorst'’ÉΣ1²-_ \n\t~<|w/>"), max_size=40))
def test_backtracking_on_made_up_texts(word_bpe, text):
    library, tokenizer = _both(word_bpe)
    assert np.frombuffer(tokenizer.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


_kept: dict = {}


def _both(path):
    if path not in _kept:
        _kept[path] = (Tokenizer.from_file(path), bpe.WordTokenizer(path))
    return _kept[path]


def test_bpe_edge_cases(spark, edge, nothing, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    lines = bpe.round_trip_digests(edge, word_bpe, keep_ids=True).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in lines) == sorted(
        (r.doc_id or 0, library.encode(r.text or "", add_special_tokens=False).ids) for r in edge.collect()
    )
    decoded = bpe.decode_documents(bpe.encode_documents(edge, word_bpe), word_bpe)
    hashes = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in decoded.collect()}
    assert hashes == {(r.doc_id, r.decoded_sha256) for r in lines}
    assert bpe.round_trip_digests(nothing, word_bpe).count() == 0


def test_every_code_point_is_coded_as_the_library_does(word_bpe):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b {c}" for c in points[at : at + 256]) for at in range(0, len(points), 256)]
    library = Tokenizer.from_file(word_bpe)
    library.no_truncation()
    library.no_padding()
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    own = bpe.WordTokenizer(word_bpe).encode(texts)
    assert [i for i, (a, b) in enumerate(zip(own, wanted)) if np.frombuffer(a, "<u4").tolist() != b] == []


def test_words_hold_the_first_ids_that_fit():
    ids = np.concatenate([np.arange(3000) % 7, np.array([1 << 63, 1, 1 << 61, 0]), np.arange(5000) * 977 % 50000]).astype(np.uint64)
    words, offsets = [], []
    for start in range(0, len(ids), simple8b.BLOCK):
        offsets.append(len(words))
        block = [int(i) for i in ids[start : start + simple8b.BLOCK]]
        at = 0
        while at < len(block):
            for s in range(1, simple8b.ESCAPE):
                held = (block[at:] + [0] * simple8b.MARGIN)[: simple8b.COUNTS[s]]
                if max(held).bit_length() <= simple8b.WIDTHS[s]:
                    words.append(s << 60 | sum(i << k * int(simple8b.WIDTHS[s]) for k, i in enumerate(held)))
                    at += len(held)
                    break
            else:
                words += [simple8b.ESCAPE << 60, block[at]]
                at += 1
    made = simple8b.pack(ids)
    assert made[0].tolist() == words and made[1].tolist() == offsets


def test_token_files_keep_a_million_chunks(byte_bpe):
    assert simple8b._encoder(byte_bpe).known.kept >= 1_000_000


def test_the_pipeline_keeps_fewer_chunks(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    made = []
    monkeypatch.setattr(bpe, "round_trip_digests", lambda *a, **options: made.append(options))
    corpus_pipeline.encode(spark, None, str(tmp_path))
    assert 2 * made[0]["kept"] <= 200_000
    assert bpe._tokenizer(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"), 7).known.kept == 7
