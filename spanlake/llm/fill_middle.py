"""Fill-in-the-middle rearrangement, with cuts found by a learned rank index.

The boundaries of a text's units are a function of their rank that is nearly a straight line. The index holds pieces of lines that
miss no boundary by more than a set error, and for each boundary the miss in one small number, so any rank's offset is
predicted by its piece and put right by its residual.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.chunks import release, slices
from spanlake.llm.scratch import small_batches, unused

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 64
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
#: Boundaries that are tried for a piece at first; doubled as long as all fit.
_REACH = 512


@dataclass
class RankIndex:
    """first: the rank with which each piece begins; start, slope: its line; residual: true offset less the predicted one, of every rank."""

    first: np.ndarray
    start: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Greedy: each piece goes through its first boundary and is as long as some slope misses none by more than `error`."""
        first, start, slope = [], [], []
        at, n = 0, len(offsets)
        while at < n:
            low, high, reach, taken = -np.inf, np.inf, _REACH, 1
            while at + taken < n:
                end = min(n, at + taken + reach)
                run = np.arange(taken, end - at, dtype=np.float64)
                rise = offsets[at + taken : end] - offsets[at]
                lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
                fits = lows <= highs
                if not fits.all():
                    k = int(np.argmin(fits))
                    if k:
                        low, high = lows[k - 1], highs[k - 1]
                    taken += k
                    break
                low, high, taken, reach = lows[-1], highs[-1], taken + len(run), reach * 2
            first.append(at)
            start.append(offsets[at])
            slope.append((low + high) / 2 if taken > 1 else 0.0)
            at += taken
        out = cls(np.array(first, np.int64), np.array(start, np.int64), np.array(slope, np.float64), np.zeros(0, np.int8))
        misses = offsets - out.predicted(np.arange(n))
        # A line between the bounds misses by at most `error`, and by half an offset more where it is rounded.
        out.residual = misses.astype(np.min_scalar_type(-(error + 1)))
        return out

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, ranks, side="right") - 1
        return self.start[piece] + np.rint((ranks - self.first[piece]) * self.slope[piece]).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks]


def boundaries(text: str) -> np.ndarray:
    """0 and the end of each unit, in code points: a unit is a word with the white space (x20, x09 to x0D) before it, or white space at the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = (points != 0x20) & ((points < 0x09) | (points > 0x0D))
    last = word.copy()
    last[:-1] &= ~word[1:]
    if len(word) and not word[-1]:
        last[-1] = True
    return np.concatenate([[0], np.flatnonzero(last) + 1])


def rearranged(text: str, index: RankIndex, cuts: tuple[int, int], form: str) -> tuple[str, int, int]:
    """The text in its form, and the code points of prefix and middle; cuts are ranks in any order."""
    a, b = index.offset(np.array(sorted(cuts))).tolist()
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    out = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if form == "spm" else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return out, a, b - a


def restored(output: str, form: str) -> str:
    """The text of an output. No text with a mark is rearranged and no mark can begin inside another, so the first of each is ours."""
    if form == "plain":
        return output
    one, two = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    x, rest = output[len(one) :].split(two, 1)
    y, middle = rest.split(MIDDLE, 1)
    return y + middle + x if form == "spm" else x + middle + y


def drawn(doc_id: str, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transform(text: str, doc_id: str, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, error: int = ERROR) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    offsets = boundaries(text)
    n, (h1, h2, h3, h4) = len(offsets) - 1, drawn(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < suffix_first else "psm"
    output, a, b = rearranged(text, RankIndex.fit(offsets, error), (h1 % (n + 1), h2 % (n + 1)), form)
    return n, form, a, b, output


ADDED = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}


def _transformed(names: dict[str, str], seed: int, rate: int, suffix_first: int, error: int):
    kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [transform(t or "", "" if i is None else str(i), seed, rate, suffix_first, error) for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())]
                for (name, kind), values in zip(kinds.items(), zip(*rows)):
                    part = part.append_column(names[name], pa.array(values, kind))
                yield part
        release()

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, error: int = ERROR) -> DataFrame:
    """`docs` with n, form, prefix_chars, middle_chars and output.

    The n units of a text are words with the white space before them. Two ranks drawn from the sha256 of seed and doc_id cut it into prefix,
    middle and suffix; `rate` of 100 documents are rearranged, `suffix_first` of 100 of these as <S>suffix<P>prefix<M>middle (spm), the others
    as <P>prefix<S>suffix<M>middle (psm). All else is plain, and so are empty and null texts (both give an empty output) and texts that hold a mark.
    A null doc_id counts as an empty one, so such rows are cut alike if their texts are; repeated rows come out alike; every row and column
    stays, and a column of docs with one of the new names stays too, the new one getting underscores before its name. Empty tables stay empty.
    """
    small_batches(docs.sparkSession)
    free, taken = unused(docs, *ADDED), {c.lower() for c in docs.columns}
    names = {k: k if k not in taken else v for k, v in free.items()}
    fields = T.StructType([*docs.schema.fields, *(T.StructField(names[k], kind) for k, kind in ADDED.items())])
    return docs.mapInArrow(_transformed(names, seed, rate, suffix_first, error), fields)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [restored(o, f) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
        yield batch.append_column("restored", pa.array(texts, pa.string()))


def restore(transformed: DataFrame) -> DataFrame:
    """`restored` beside `output` and `form`: the exact text that an output was made from."""
    fields = T.StructType([*transformed.schema.fields, T.StructField("restored", T.StringType())])
    return transformed.mapInArrow(_restored, fields)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the sha256 of output and of the text restored from it."""
    made = restore(fill_in_middle(docs.select("doc_id", "text")).drop("text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


#: The contract in SQL, by lists of units.
ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle, coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p"""
