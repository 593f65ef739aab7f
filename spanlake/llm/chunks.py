"""Texts as sequences of few distinct pieces.

A tokenizer whose pre-tokenizer never joins a character to a following space can be run on the chunks
between spaces one by one. Arrow splits a batch and numbers its distinct chunks, cuts these again where a
pre-token is sure to end (a letter before punctuation, punctuation before a letter, a single line feed),
the tokenizer sees each new piece once, and numpy puts the ids of whole texts together.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of any kind before a space: such texts are encoded in one piece, as are those with a zero byte.
SPACE_RUN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] |\x00"
SLICE_BYTES = 8 << 20
MEMORY_BYTES = 48 << 20

#: Letters that every version of Unicode and every normal form leaves one letter each, in upper and in lower case.
LETTER = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{148}\x{14A}-\x{17E}"
#: ASCII signs; an apostrophe may begin a pre-token that goes on with letters.
SIGN, APOSTROPHE = r"!-&(-/:-@\[-`{-~", "'"
#: Where a pre-token ends for sure, as pairs of pattern and replacement with zero bytes in between.
BOUNDARIES = (
    (rf"([{LETTER}{SIGN}{APOSTROPHE}])\n([{LETTER}{SIGN}{APOSTROPHE}])", "\\1\x00\n\x00\\2"),
    (rf"([{LETTER}])([{SIGN}{APOSTROPHE}0-9])", "\\1\x00\\2"),
    (rf"([{SIGN}])([{LETTER}])", "\\1\x00\\2"),
)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `most` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def release() -> None:
    """Give freed memory back to the system at the end of a task, as Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Memory:
    """What was computed for strings, in two generations of at most half of `most` bytes each: what is asked for again moves to
    the new one, and when that is full it becomes the old one."""

    #: Of a string, its value and their place in a dictionary, beside the characters.
    ENTRY_BYTES = 200

    def __init__(self, most: int = MEMORY_BYTES):
        self.most, self.new, self.old, self.used = most, {}, {}, 0

    def get(self, key: str):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.keep(key, value, 0)
        return value

    def keep(self, key: str, value, size: int) -> None:
        self.used += self.ENTRY_BYTES + len(key) + size
        if self.used > self.most // 2:
            self.old, self.new, self.used = self.new, {}, self.ENTRY_BYTES + len(key) + size
        self.new[key] = value


class IdMemory:
    """The ids of pieces, in two generations as in Memory, for many pieces at a time: a dictionary tells where a piece's ids
    begin in one array, and how many they are."""

    ENTRY_BYTES = 160

    def __init__(self, most: int):
        self.most, self.old, self.fresh = most, None, None
        self._turn()

    def _turn(self) -> None:
        self.old, self.fresh, self.used = self.fresh, ({}, [], 0), 0

    def find(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The numbers of the pieces that a generation has, their ids and lengths: of the new one, then of the old one."""
        out, left, asked = [], np.arange(len(pieces)), pieces
        for generation in (self.fresh, self.old or ({}, [], 0)):
            if not generation[0]:
                out.append((left[:0], np.zeros(0, np.uint32), left[:0]))
                continue
            where = np.fromiter(map(generation[0].get, asked, repeat(-1)), np.int64, len(asked))
            hit = where >= 0
            at, lengths = where[hit] >> 16, where[hit] & 0xFFFF
            ids = np.concatenate(generation[1])
            generation[1][:] = [ids]
            starts = np.cumsum(lengths) - lengths
            out.append((left[hit], ids[np.repeat(at - starts, lengths) + np.arange(lengths.sum())], lengths))
            left = left[~hit]
            asked = [pieces[i] for i in left.tolist()]
        return out

    def keep(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Pieces that are not in the new generation, 2 ** 16 ids a piece at most."""
        size = self.ENTRY_BYTES * len(pieces) + sum(map(len, pieces)) + ids.nbytes
        if self.used + size > self.most // 2:
            self._turn()
        known, parts, n = self.fresh
        starts = n + np.cumsum(lengths) - lengths
        known.update(zip(pieces, (starts << 16 | lengths).tolist()))
        parts.append(ids)
        self.fresh = (known, parts, n + len(ids))
        self.used += size


def gathered(table: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `table` (one after another, of these lengths) that `codes` number, and where each begins (one more at the end)."""
    first, each = np.cumsum(lengths) - lengths, lengths[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    return table[np.repeat(first[codes] - ends[:-1], each) + np.arange(ends[-1])], ends


class Chunked:
    """Distinct chunks of a batch (`chunks`), and for each text its run of chunk numbers
    (`codes[offsets[i]:offsets[i + 1]]`). Empty chunks are left out. The chunks from `apart` on are whole texts."""

    def __init__(self, texts: pa.Array, keep_space: bool):
        texts = pc.fill_null(texts, "").cast(pa.string())
        n = len(texts)
        whole = pc.match_substring_regex(texts, SPACE_RUN if keep_space else r"\x00").to_numpy(zero_copy_only=False)
        cut = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        lists = pc.split_pattern(cut, " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts = starts - starts[0]
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        if keep_space:
            later = np.ones(len(codes), np.int64)
            later[starts[:-1]] = 0
            codes = codes * 2 + later
            used = np.flatnonzero(np.bincount(codes, minlength=2 * len(words)))
            table = np.zeros(2 * len(words), np.int64)
            table[used] = np.arange(len(used))
            codes = table[codes]
            spaces = pa.array(["", " "]).take(pa.array(used & 1))
            words = pc.binary_join_element_wise(spaces, words.take(pa.array(used >> 1)), "")
        self.apart = len(words)
        if whole.any():
            at = np.flatnonzero(whole)
            codes[starts[at]] = len(words) + np.arange(len(at))
            words = pa.concat_arrays([words, texts.take(pa.array(at))])
        full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)[codes] if len(words) else np.zeros(0, bool)
        kept = np.concatenate([[0], np.cumsum(full)])
        self.codes, self.offsets, self.chunks = codes[full], kept[starts], words
        assert len(self.offsets) == n + 1

    def pieces(self, fold: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct pieces of the chunks, the numbers of each chunk's pieces one after another, and how many each has.
        fold: ASCII pieces in lower case, for a tokenizer that makes no difference."""
        cut = self.chunks.slice(0, self.apart)
        for pattern, put in BOUNDARIES:
            cut = pc.replace_substring_regex(cut, pattern, put)
        lists = pc.split_pattern(cut, "\x00")
        flat = lists.flatten()
        if fold:
            flat = pc.if_else(pc.string_is_ascii(flat), pc.ascii_lower(flat), flat)
        coded = pa.concat_arrays([flat, self.chunks.slice(self.apart)]).dictionary_encode()
        each = np.concatenate([lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), np.ones(len(self.chunks) - self.apart, np.int64)])
        return coded.dictionary, coded.indices.to_numpy().astype(np.int64), each


#: Pieces that the tokenizer sees in one string.
TOGETHER = 64
#: Longer pieces are not remembered.
REMEMBERED_CHARS = 64


class ChunkEncoder:
    """Token ids of texts by a tokenizers file, with a bounded memory of pieces.

    keep_space: the file's tokens hold the space before a word (byte level); otherwise it drops white space, marks the
    ends of words and makes no difference of case. So pieces of letters can go to the tokenizer many at a time: the first or last token of each shows."""

    def __init__(self, path: str, keep_space: bool, memory: int = MEMORY_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.keep_space, self.memory = keep_space, IdMemory(memory)
        self.edge = np.zeros(self.vocabulary, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.edge[number] = token.startswith("\u0120") if keep_space else token.endswith("</w>")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        lists = [x.ids for x in self.batch(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of letters (keep_space: after a space) that are one pre-token each."""
        between = "" if self.keep_space else " "
        ids, _ = self.encode([between.join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)])
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words):  # a file that is made otherwise
            return self.encode(words)
        bounds = np.append(edges, len(ids)) if self.keep_space else np.concatenate([[0], edges + 1])
        return ids, np.diff(bounds)

    def known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        found = self.memory.find(names)
        missing = np.ones(len(names), bool)
        for at, _, _ in found:
            missing[at] = False
        words = pc.match_substring_regex(pieces, rf"^ [{LETTER}]+$" if self.keep_space else rf"^[{LETTER}]+$").to_numpy(zero_copy_only=False)
        short = pc.less_equal(pc.utf8_length(pieces), REMEMBERED_CHARS).to_numpy(zero_copy_only=False)
        for rows, encode in ((missing & words, self.encode_words), (missing & ~words, self.encode)):
            at = np.flatnonzero(rows)
            for lo in range(0, len(at), 20_000):
                part = at[lo : lo + 20_000]
                found.append((part, *encode([names[i] for i in part.tolist()])))
        for at, ids, lengths in found[1:]:
            few = short[at]
            self.memory.keep([names[i] for i in at[few].tolist()], ids[np.repeat(few, lengths)], lengths[few])
        order, table, lengths = (np.concatenate([x[i] for x in found]) for i in range(3))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        table, ends = gathered(table, lengths, back)
        return table, np.diff(ends)

    def __call__(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin (one more at the end).
        `end`: an id put after each text."""
        parts = Chunked(texts, self.keep_space)
        pieces, numbers, each = parts.pieces(fold=not self.keep_space)
        # The ids of each distinct piece, then of each distinct chunk, then of all texts.
        table, ends = gathered(*self.known(pieces), numbers)
        lengths = np.diff(ends[np.concatenate([[0], np.cumsum(each)])])
        codes, offsets = parts.codes, parts.offsets
        if end is not None:
            table, lengths = np.append(table, np.uint32(end)), np.append(lengths, 1)
            codes = np.insert(codes, offsets[1:], len(lengths) - 1)
            offsets = offsets + np.arange(len(offsets))
        ids, ends = gathered(table, lengths, codes)
        return ids, ends[offsets]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def library_encoder(path: str, keep_space: bool) -> ChunkEncoder:
    """The encoder of a tokenizers file, one for each Python worker."""
    key = (path, keep_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, keep_space)
    return _ENCODERS[key]
