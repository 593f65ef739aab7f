"""Operators 2, 8 and 10 against the tokenizers themselves."""

import base64
import functools
import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import empty, table
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import byte_bpe, packing, token_store
from spanlake.llm.chunks import ChunkEncoder, Chunked, Memory, library_encoder, slices

os.environ["TOKENIZERS_PARALLELISM"] = "false"
P = pytest.importorskip("public_tokenizers")
BYTE, WORD, RANKS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


def tokenizer(path):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@functools.cache
def tokenizer_of(path):
    return tokenizer(path)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=800):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "B", "12", "'s", "é", "Σ", "́", ".", "!", " ", "\x1c", "İ", "<|endoftext|>", "the", "日本"]
    return [None, "", " ", "   ", "<|endoftext|>", "a   b", "a\n  b "] + ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(n)]


@pytest.mark.parametrize("path, keep", [(BYTE, True), (WORD, False)])
def test_chunks_encode_as_whole_texts(path, keep):
    texts, whole = odd_texts(), tokenizer(path)
    ids, at = library_encoder(path, keep)(pa.array(texts), end=7)
    for text, a, b in zip(texts, at, at[1:]):
        assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [7], repr(text)


@given(st.lists(st.text(max_size=20), max_size=6))
@settings(max_examples=150, deadline=None)
def test_chunks_give_the_texts_back(texts):
    parts = Chunked(pa.array(texts, pa.string()), keep_space=True)
    chunks = parts.chunks.to_pylist()
    pieces, numbers, each = parts.pieces(fold=False)
    ends = np.concatenate([[0], np.cumsum(each)])
    assert ["".join(pieces[i].as_py() for i in numbers[a:b].tolist()) for a, b in zip(ends, ends[1:])] == chunks
    back = ["".join(chunks[c] for c in parts.codes[a:b]) for a, b in zip(parts.offsets, parts.offsets[1:])]
    assert back == texts


@pytest.mark.parametrize("path, keep", [(BYTE, True), (WORD, False)])
def test_pieces_encode_as_whole_texts(path, keep):
    """Cuts at letters, signs and line feeds, pieces many at a time, and a memory so small that it turns all the time."""
    rng, whole = random.Random(11), tokenizer(path)
    parts = ["a", "Bc", "don", "'s", "'ll", "'", "''", ",", ".", '."', "\n", "\n\n", "\t", "\r\n", " ", "  ", "0", "42", "é", "İ", "ı", "ǰ", "Σ", "\u0301", "e\u0301", "\u0307", "ŉ", "ſ", "½", "日", "\x00", "\u00a0", "\u2028", "_", "ß", "Å", "ſt", "ĳ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    encoder = ChunkEncoder(path, keep, memory=20_000)
    for lo in range(0, len(texts), 500):
        ids, at = encoder(pa.array(texts[lo : lo + 500]))
        for text, a, b in zip(texts[lo:], at, at[1:]):
            assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@given(st.lists(st.text(max_size=30), max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text_encodes_as_the_whole(texts):
    for path, keep in ((BYTE, True), (WORD, False)):
        ids, at = library_encoder(path, keep)(pa.array(texts, pa.string()))
        want = [x.ids for x in tokenizer_of(path).encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_memory_is_bounded_and_keeps_what_is_asked_again():
    memory = Memory(10_000)
    for i in range(1000):
        memory.keep(str(i), i, 8)
        assert memory.get("0") == 0 and len(memory.new) + len(memory.old) < 60


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 50, 7, 7, 7)] + [None])], ["text"])
    assert [t for s in slices(batch, "text", 10) for t in s.column("text").to_pylist()] == batch.column("text").to_pylist()


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70), st.integers(0, 70), st.integers(0, 70))
@settings(max_examples=200, deadline=None)
def test_bits_round_trip_and_read_at_random(bits, ids, first, count):
    ids = np.array([i & ((1 << bits) - 1) for i in ids], np.uint32)
    packed = token_store.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    first = min(first, len(ids))
    count = min(count, len(ids) - first)
    assert token_store.unpack(packed, bits, first, count).tolist() == ids[first : first + count].tolist()


def test_least_width():
    assert [token_store.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("clash", [False, True])
def test_store_gives_every_document_back(spark, tmp_path, clash):
    docs, whole = table(spark, clash=clash), tokenizer(BYTE)
    path = str(tmp_path / "store")
    token_store.write_tokens(docs, path, BYTE, shards=3, block_ids=100)
    got = [tuple(r) for r in token_store.document_digests(spark, path).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((i or -1, n, c) for i, n, c in want)
    assert [r[0] for r in got] == [i for i, _, _ in want]
    assert [r[2:] for r in got] == [(n, c) for _, n, c in want]
    with pytest.raises(KeyError):
        token_store.read_range(spark, path, 123_456, 0, 1)
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])])[:-1].tolist() and got[-1][1] + got[-1][2] == start
    assert token_store.read_range(spark, path, 1, 3, 5).tolist() == (whole.encode(dict(rows)[1], add_special_tokens=False).ids + [2])[3:8]


def test_empty_store(spark, tmp_path):
    token_store.write_tokens(empty(spark), str(tmp_path / "s"), BYTE)
    assert token_store.document_digests(spark, str(tmp_path / "s")).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
@settings(max_examples=200, deadline=None)
def test_packs_hold_all_pieces_and_no_more_than_fits(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held = defaultdict(int)
    for pattern, count in patterns:
        assert count > 0 and 0 < sum(pattern) <= 64
        for size in pattern:
            held[size] += count
    assert dict(held) == histogram
    ranks = defaultdict(list)
    for size, a, b, *_ in packing.slots(patterns):
        ranks[size].append((a, b))
    for size, spans in ranks.items():
        assert spans[0][0] == 0 and spans[-1][1] == histogram[size] - 1 and all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:]))


def piece_by_piece(histogram, length):
    """Shortest pack first as defined: each piece, longest first, into the emptiest pack if it fits there, else into a new one."""
    packs = []
    for size in sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True):
        if packs and min(packs) + size <= length:
            packs[packs.index(min(packs))] += size
        else:
            packs.append(size)
    return sorted(packs)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25))
@settings(max_examples=300, deadline=None)
def test_packs_are_those_of_one_piece_at_a_time(histogram):
    assert sorted(sum(p) for p, n in packing.shortest_pack_first(histogram, 64) for _ in range(n)) == piece_by_piece(histogram, 64)


@pytest.mark.parametrize("clash", [False, True])
def test_packed_sequences_have_no_gaps_and_every_id(spark, clash):
    docs, whole = table(spark, clash=clash), tokenizer(WORD)
    packed = packing.pack_documents(docs, WORD, length=256, keep_ids=True, part_rows=7)
    rows = packed.collect()
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 256
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(whole.encode(r.text or "", add_special_tokens=False).ids + [1])
    for doc_id, found in pieces.items():
        got = b"".join(r.ids for r in sorted(found, key=lambda r: r.start)) if len(texts[doc_id]) == 1 else None
        if got is not None:
            assert np.frombuffer(got, "<u4").tolist() == texts[doc_id][0] and {r.doc_tokens for r in found} == {len(texts[doc_id][0])}
        assert sum(r.length for r in found) == sum(map(len, texts[doc_id]))
    assert packing.padding(packed, 256).first().padding < 0.3


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(empty(spark), WORD).count() == 0


def test_byte_bpe_encodes_as_merges_do(reference):
    bpe, _ = byte_bpe.coder(RANKS, P.PATTERN)
    for text in odd_texts():
        assert bpe.encode(text or "") == reference.encode_ordinary(text or ""), repr(text)
    rng = random.Random(9)
    for _ in range(1500):
        piece = bytes(rng.choice(b"abcde the in\xc3\xa9ing\xff") for _ in range(rng.randint(1, 40)))
        assert bpe.encode_piece(piece) == reference._encode_single_piece(piece) == bpe.merged(piece)


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_byte_bpe_round_trip(text):
    bpe, _ = byte_bpe.coder(RANKS, P.PATTERN)
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_byte_bpe_with_a_small_vocabulary_that_needs_backtracking():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 258, b"cd": 259, b"aa": 260, b"aaa": 261}
    bpe = byte_bpe.ByteBpe(ranks, r"\S+|\s+")
    rng = random.Random(1)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 14)))
        assert bpe.encode_piece(piece) == ([ranks[piece]] if piece in ranks else bpe.merged(piece))


@pytest.mark.parametrize("clash", [False, True])
def test_digests_encode_and_decode(spark, reference, clash):
    docs = table(spark, clash=clash)
    want = sorted((r.doc_id or -1, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect() for e in [reference.encode_ordinary(r.text or "")])
    assert sorted((r[0] or -1, *r[1:]) for r in byte_bpe.round_trip_digests(docs, RANKS, P.PATTERN).collect()) == want
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((r.text or "").encode() for r in docs.collect())
    assert byte_bpe.round_trip_digests(empty(spark), RANKS, P.PATTERN).count() == 0
