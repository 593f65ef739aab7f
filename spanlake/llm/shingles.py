"""Words of a text as 64-bit hashes, and sets of word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multipliers that spread bits.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of the texts with A-Z in lower case, one after another, and where each text's begin.
    Null texts have none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string())))
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), kept[starts - starts[0]]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = words_of(texts)
    if not len(flat):
        return np.zeros(0, np.uint64), offsets
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy()], offsets


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, as if they were one text; empty if there are fewer."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out * _B + words[i : i + n])
    return out


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """For each text its distinct shingles of k words, ascending; with fewer words the whole sequence is one."""
    words, offsets = word_hashes(texts)
    runs = window_hashes(words, k)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        else:
            out.append(window_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
