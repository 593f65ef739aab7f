"""Byte-level BPE by longest matches and backtracking.

The vocabulary's byte strings, read as Latin-1 text, are the words of an Aho-Corasick automaton. One pass
over a piece tells the longest token that starts at each byte. Encoding takes longest tokens and goes back
to shorter ones where two neighbours could not stand side by side after BPE's merges; whether two can is
remembered, so a text costs time in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.chunks import REMEMBERED_CHARS, Chunked, Memory, slices

PAIR_ENTRIES = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {rank: word for word, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = Memory()
        # A token that its own merges do not give back can only be a whole piece.
        sound = {w for w, r in ranks.items() if len(w) == 1 or self.merged(w) == [r]}
        for word in sound:
            self.automaton.add_word(word.decode("latin-1"), (ranks[word], len(word)))
        self.automaton.make_automaton()
        for word in sound:
            rest = next((word[:n] for n in range(len(word) - 1, 0, -1) if word[:n] in sound), None)
            self.shorter[ranks[word]] = None if rest is None else ranks[rest]

    def merged(self, piece: bytes) -> list[int]:
        """The merges done one by one, lowest rank first: the definition, for short inputs."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[x] for x in parts]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether BPE leaves token b right after token a."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest = [0] * len(piece)
        for end, (rank, size) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank  # ends come in order, so the last to start here is the longest
        out: list[int] = []
        usable = bytearray(b"\1" * (len(piece) + 1))
        at, rank = 0, longest[0]
        while True:
            while rank is not None:
                end = at + len(self.token[rank])
                if usable[end] and (not out or self.neighbours(out[-1], rank)):
                    break
                rank = self.shorter[rank]
            if rank is None:  # nothing fits after what stands before: this place is no boundary
                usable[at] = 0
                rank = out.pop()
                at -= len(self.token[rank])
                continue
            out.append(rank)
            at = end
            if at == len(piece):
                return out
            rank = longest[at]

    def encode_new(self, text: str) -> list[int]:
        """The ids of a text that is not worth a place in the memory of pieces."""
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = tuple(self.encode_piece(piece.encode()))
                if len(piece) <= REMEMBERED_CHARS:
                    self.pieces.keep(piece, ids, 8 * len(ids))
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_CODERS: dict[tuple, tuple[ByteBpe, Memory]] = {}


def coder(path: str, pattern: str) -> tuple[ByteBpe, Memory]:
    """One for each Python worker, with its memory of texts' pieces as digests need them."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = (ByteBpe(load_ranks(path), pattern), Memory())
    return _CODERS[path, pattern]


def _joined(parts: pa.Array, codes: np.ndarray, offsets: np.ndarray, by: bytes) -> pa.Array:
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), parts.take(pa.array(codes)))
    return pc.binary_join(lists, pa.scalar(by, pa.large_binary()))


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Chunked(part.column("text"), keep_space=True)
                pieces, numbers, each = texts.pieces(fold=False)
                found = []
                for piece in pieces.to_numpy(zero_copy_only=False).tolist():
                    x = known.get(piece)
                    if x is None:
                        ids = bpe.encode_new(piece)
                        x = (" ".join(map(str, ids)).encode(), bpe.decode(ids), len(ids))
                        if len(piece) <= REMEMBERED_CHARS:
                            known.keep(piece, x, 200 + len(x[0]) + len(x[1]))
                    found.append(x)
                # What is known of pieces is put together for each distinct chunk, and this for each text.
                ends = np.concatenate([[0], np.cumsum(each)])
                whole = lambda i, by: _joined(_joined(pa.array([x[i] for x in found], pa.large_binary()), numbers, ends, by), texts.codes, texts.offsets, by)
                sizes = np.concatenate([[0], np.cumsum(np.array([x[2] for x in found], np.int64)[numbers])])
                sizes = np.concatenate([[0], np.cumsum(np.diff(sizes[ends])[texts.codes])])
                ids, back = whole(0, b" "), whole(1, b"")
                sha = lambda column: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(sizes[texts.offsets]), pa.int64()), sha(ids), sha(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([bpe.encode(x or "") for x in part.column("text").to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = coder(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([bpe.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return run


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids of every document, in the table's own partitions. Null text: no ids. Other columns are dropped,
    equal rows give equal rows, an empty table gives an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(ranks, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, decoded (bytes) from doc_id, ids. Null ids: no bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(ranks, pattern), "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space), decoded_sha256 (bytes decoded from these ids),
    in one pass without a shuffle. Null text counts as empty and has no ids; a null doc_id stays; equal rows give equal rows, whole texts
    are read however long they are, an empty table gives an empty one, and other columns are dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_digests(ranks, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
