"""Spelling variants: words one code point apart, found by an index of grams of variable length.

A gram is in the dictionary if it has GRAM_LEAST letters, or if what is left without its last letter is frequent in the words; so a
gram grows until it is rare or has GRAM_MOST letters. A word is cut into the longest gram at each place, without those that lie
inside another. For each place of a word the grams that an edit there could change are counted; the largest such count is the
word's bound. Two words one edit apart share all other grams, those before the edit with all that stands before them and those after it
with all that follows, so of each word's lists only bound + 1, those of the rarest grams, are merged. What meets there is verified.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.chunks import release, slices
from spanlake.llm.scratch import discard, written
from spanlake.llm.shingles import mixed

WORD_LETTERS, WORD_COUNT = 7, 2
GRAM_LEAST, GRAM_MOST = 2, 7
#: A gram is frequent above so many places of all words, and above 1 / FREQUENT_MOST of them: that bounds the broadcast dictionary.
FREQUENT_PLACES, FREQUENT_MOST = 2_000, 65_536
ERROR_EVERY, FORM_TIMES = 31, 10
#: Bits of a letter in the number of a gram.
_BITS = 7
#: Cells of the matrix in which words of one length are worked on together.
_CELLS = 1 << 20
#: A run of more bytes is hashed by itself.
_LONG = 64


# words and their counts


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table.astype(np.uint32)


CRC = _crc_table()


def letter_runs(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes with A-Z in lower case; begin, end, code points and text of each maximal run [A-Za-z\\u00C0-\\u00FF]+ of at
    least `least` code points. Null texts have none."""
    lower = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string()))
    offsets = np.frombuffer(lower.buffers()[1], np.int32)[lower.offset : lower.offset + len(lower) + 1].astype(np.int64) if len(lower) else np.zeros(1, np.int64)
    raw = lower.buffers()[2] if len(lower) else None
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    size = len(data)
    lead = data == 0xC3  # of the two bytes of U+00C0 to U+00FF, and of no other code point
    letter = ((data >= 97) & (data <= 122)) | lead
    letter[1:] |= lead[:-1]
    bounds = offsets[(offsets > 0) & (offsets < size)]
    opens, closes = letter.copy(), letter.copy()
    opens[1:] &= ~letter[:-1]
    closes[:-1] &= ~letter[1:]
    opens[bounds] = letter[bounds]
    closes[bounds - 1] = letter[bounds - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    points = end - start - (leads[end] - leads[start])
    kept = points >= least
    start, end, points = start[kept], end[kept], points[kept]
    return data, start, end, points, np.searchsorted(offsets, start, side="right") - 1


def run_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of what each seed stands for, followed by the run; all runs a byte at a time."""
    length = end - start
    order = np.argsort(-np.minimum(length, _LONG + 1).astype(np.int16), kind="stable")
    sizes, begin = length[order], start[order]
    state = seeds[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-sizes, -_LONG, side="left"))
    for j in range(int(sizes[long]) if long < len(sizes) else 0):
        n = int(np.searchsorted(-sizes[long:], -j, side="left")) + long
        now = state[long:n]
        state[long:n] = CRC[(now ^ data[begin[long:n] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(start), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(seeds[i]))
    return out


def _counted(letters: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, start, end, points, doc = letter_runs(part.column("text"), letters)
                seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in part.column("doc_id").to_pylist()], np.uint32)
                sums = run_checksums(data, start, end, seeds[doc])
                wrong = sums % np.uint32(every) == 0
                changed = []
                for i in np.flatnonzero(wrong & (points > letters)).tolist():
                    word = data[start[i] : end[i]].tobytes().decode()
                    k = int(sums[i]) % len(word)
                    changed.append(word[:k] + word[k + 1 :])
                inside = np.zeros(len(data) + 1, np.int8)
                inside[start[~wrong]] += 1
                inside[end[~wrong]] -= 1
                body = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
                ends = np.concatenate([[0], np.cumsum((end - start)[~wrong])]).astype(np.int32)
                plain = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(body))
                counts = pc.value_counts(pa.concat_arrays([plain, pa.array(changed, pa.string())]))
                yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["word", "n"])
        release()

    return run


def word_counts(docs: DataFrame, letters: int = WORD_LETTERS, count: int = WORD_COUNT, every: int = ERROR_EVERY) -> DataFrame:
    """word, n: the words of at least `letters` code points that occur at least `count` times, over whole texts.

    A word is a maximal run of letters (A-Z in lower case). One of `every` runs, chosen by the crc32 of its document's id and
    itself, loses the code point that the checksum names, as a typist would. A null doc_id counts as an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInArrow(_counted(letters, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# grams


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, and their code points as a matrix; a bounded number of cells at a time."""
    points = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for m in np.unique(points).tolist():
        places = np.flatnonzero(points == m)
        if m:
            for lo in range(0, len(places), max(1, _CELLS // m)):
                part = places[lo : lo + max(1, _CELLS // m)]
                joined = "".join(words.take(pa.array(part)).to_pylist())
                yield part, np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, m)


def letter_classes(points: np.ndarray) -> np.ndarray:
    """1 to 126: a to z and U+00C0 to U+00FF each have their own; others share, which costs candidates and loses none."""
    wide = points.astype(np.int64)
    return np.where((wide >= 97) & (wide <= 122), wide - 96, 27 + wide % 100)


def _gram_codes(classes: np.ndarray, q: int, shorter: np.ndarray | None = None) -> np.ndarray:
    """A number for the gram of q letters at each place of each word; `shorter` holds those of q - 1 letters."""
    m = classes.shape[1]
    if shorter is None:
        shorter = classes[:, : max(0, m)] if q == 1 else _gram_codes(classes, q - 1)
        if q == 1:
            return shorter
    return (shorter[:, : max(0, m - q + 1)] << _BITS) | classes[:, q - 1 :]


def _frequencies(least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in _by_length(batch.column("word")):
                classes, codes, found = letter_classes(points), None, []
                for q in range(least, min(most, points.shape[1] + 1)):
                    codes = _gram_codes(classes, q, codes)
                    found.append(np.unique(codes, return_counts=True))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in found]).astype(np.int64)) for k in (0, 1)], ["gram", "n"])

    return run


def _index_of(values: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the values are in the sorted array, and where."""
    at = np.minimum(np.searchsorted(sorted_, values), max(0, len(sorted_) - 1))
    return (sorted_[at] == values if len(sorted_) else np.zeros(values.shape, bool)), at


@dataclass
class GramDictionary:
    """frequent: the numbers of frequent grams, ascending; counts: in how many places each stands; ends: the frequent grams
    without their first letter, ascending. A beginning or an end of a frequent gram is frequent too."""

    frequent: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    least: int = GRAM_LEAST
    most: int = GRAM_MOST

    @classmethod
    def of(cls, counted: dict[int, int], least: int = GRAM_LEAST, most: int = GRAM_MOST) -> GramDictionary:
        frequent = np.array(sorted(counted), np.int64)
        letters = np.zeros(len(frequent), np.int64)
        for q in range(1, most):
            letters += frequent >= 1 << (_BITS * q)
        ends = np.unique(frequent & ((np.int64(1) << (_BITS * letters)) - 1))
        return cls(frequent, np.array([counted[int(c)] for c in frequent], np.int64), ends, least, most)

    def cut(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length: word, begin, end, number and rarity (a function of the gram; less is rarer) of each gram, and each
        word's bound: the most grams that one inserted, deleted or replaced letter can change."""
        n, m = points.shape
        classes = letter_classes(points)
        if m < self.least:
            none = np.zeros(0, np.int64)
            return none, none, none, none, none, np.zeros(n, np.int64)
        codes = _gram_codes(classes, self.least)
        places = codes.shape[1]
        end = np.broadcast_to(np.arange(places) + self.least, (n, places)).copy()
        number, rarity, grows = codes.copy(), np.zeros((n, places), np.int64), np.ones((n, places), bool)
        for q in range(self.least, min(self.most, m + 1)):
            here, at = _index_of(codes, self.frequent)
            here &= grows[:, : codes.shape[1]]
            seen = self.counts[at] if len(self.counts) else np.zeros(codes.shape, np.int64)
            grows = here
            longer = _gram_codes(classes, q + 1, codes)
            inner = longer.shape[1]
            # A frequent gram that ends with its word can't grow; it counts as the most frequent of its kind.
            rarity[:, : codes.shape[1]] = np.where(here, seen, rarity[:, : codes.shape[1]])
            rarity[:, inner : codes.shape[1]] += np.where(here, 3 * seen, 0)[:, inner:]
            number[:, :inner] = np.where(here[:, :inner], longer, number[:, :inner])
            end[:, :inner] = np.where(here[:, :inner], q + 1 + np.arange(inner), end[:, :inner])
            codes = longer
        kept = np.ones((n, places), bool)
        kept[:, 1:] = end[:, 1:] != end[:, :-1]  # what ends where the one before does lies inside it
        word, begin = np.nonzero(kept)
        end, number, rarity = end[kept], number[kept], rarity[kept]
        # An edit changes the grams around it, and can let the one just before it grow over the first one after it.
        grown = _index_of(number >> _BITS, self.ends)[0] & (begin > 0)
        width = m + 1
        change = np.bincount(word * width + begin - grown, minlength=n * width) - np.bincount(word * width + end, minlength=n * width)
        return word, begin, end, number, rarity, np.cumsum(change.reshape(n, width), axis=1).max(axis=1)


def letter_signature(points: np.ndarray) -> np.ndarray:
    """63 bits: three for each of 21 classes of letters, set for at least 1, 2 and 3 of them. A replaced letter changes two bits at most,
    an inserted or deleted one."""
    kinds = letter_classes(points) % 21
    out = np.zeros(len(points), np.int64)
    for k in range(21):
        n = np.minimum((kinds == k).sum(axis=1), 3)
        out |= ((np.int64(1) << n.astype(np.int64)) - 1) << (3 * k)
    return out


def _parts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of what stands before each place of each word and of what stands from it on, (words, length + 1), and of each word
    without each of its letters and whole."""
    with np.errstate(over="ignore"):
        n, m = points.shape
        base, letters = np.uint64(0x9E3779B97F4A7C15), points.astype(np.uint64) + np.uint64(1)
        power = np.ones(m + 1, np.uint64)
        for i in range(m):
            power[i + 1] = power[i] * base
        before, after = np.zeros((n, m + 1), np.uint64), np.zeros((n, m + 1), np.uint64)
        for i in range(m):
            before[:, i + 1] = before[:, i] * base + letters[:, i]
            j = m - 1 - i
            after[:, j] = after[:, j + 1] + letters[:, j] * power[i]
        one = before[:, :m] * power[None, :m][:, ::-1] + after[:, 1:]
        return before, after, np.concatenate([mixed(one + np.uint64(m - 1)), mixed(before[:, m:] + np.uint64(m))], axis=1)


def _lists(dictionary):
    """mapInArrow: a row for each list that a word is in: key, and the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = dictionary.value
        for batch in batches:
            for places, points in _by_length(batch.column("word")):
                m = points.shape[1]
                word, begin, end, number, rarity, bound = d.cut(points)
                # Equal grams stay in the order of their places, which is the same in both words of a pair.
                order = np.lexsort((number, rarity, word))
                word, begin, end, number = word[order], begin[order], end[order], number[order]
                first = np.searchsorted(word, np.arange(len(points)))
                grams = np.bincount(word, minlength=len(points))
                merged = np.arange(len(word)) - first[word] <= bound[word]
                word, begin, end, number = word[merged], begin[merged], end[merged], number[merged]
                before, after, without = _parts(points)
                # A shared gram stands before the edit, and all before it is shared too, or after the edit, and all after it is.
                with np.errstate(over="ignore"):
                    place = lambda x, side: mixed(x.astype(np.uint64) * np.uint64(4) + np.uint64(side))
                    from_start = mixed(before[word, end] + place(end, 1) + mixed(place(begin, 1)))
                    from_end = mixed(after[word, begin] + place(m - begin, 2) + mixed(place(m - end, 2)))
                # Words that one edit can change in all grams also meet each other without a letter.
                bare = np.flatnonzero(grams <= bound)
                without = np.sort(without[bare], axis=1)
                once = np.ones(without.shape, bool)
                once[:, 1:] = without[:, 1:] != without[:, :-1]
                keys = np.concatenate([from_start, from_end, without[once]]).view(np.int64)
                row = np.concatenate([word, word, bare[np.nonzero(once)[0]]])
                signature = letter_signature(points)
                for lo in range(0, len(keys), 200_000):
                    r = row[lo : lo + 200_000]
                    at = pa.array(places[r])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + 200_000]), *[batch.column(c).take(at) for c in ("word_id", "word", "n")], pa.array(signature[r])], ["key", "word_id", "word", "n", "signature"])
        release()

    return run


def gram_dictionary(words: DataFrame, least: int = GRAM_LEAST, most: int = GRAM_MOST, places: int = FREQUENT_PLACES, at_most: int = FREQUENT_MOST) -> GramDictionary:
    """The dictionary of all words, pruned by frequency. At most `at_most` grams of each length are frequent, whatever the table."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    counted = words.select("word").mapInArrow(_frequencies(least, most), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return GramDictionary.of({r["gram"]: r["n"] for r in counted.where(F.col("n") > max(places, total // at_most)).collect()}, least, most)


def near_pairs(words: DataFrame, dictionary: GramDictionary) -> DataFrame:
    """a, b, n_a, n_b: pairs of words (ids, a < b) with exactly one code point inserted, deleted or replaced. `words` has word_id, word, n; words differ.

    The words of a list meet by a join on its key, which Spark splits over tasks where a list is long."""
    spark = words.sparkSession
    lists = written(words.mapInArrow(_lists(spark.sparkContext.broadcast(dictionary)), "key long, word_id long, word string, n long, signature long"), "lists")
    a, b = lists.alias("a"), lists.alias("b")
    alike = (F.col("a.word_id") < F.col("b.word_id")) & (F.bit_count(F.col("a.signature").bitwiseXOR(F.col("b.signature"))) <= 2)
    one_edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    met = a.join(b.hint("merge"), F.col("a.key") == F.col("b.key")).where(alike & one_edit)
    return met.select(F.col("a.word_id").alias("a"), F.col("b.word_id").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word_id, root_id: where following the forms ends. `forms` (word_id, form_id) has no cycles; each round doubles the steps."""
    now = written(forms.select("word_id", F.col("form_id").alias("root_id")), "roots")
    while True:
        further = now.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("__next"))
        after = written(now.join(further, "root_id", "left").select("word_id", F.coalesce("__next", "root_id").alias("root_id"), F.col("__next").isNotNull().alias("__moved")), "roots")
        moved = after.where("__moved").limit(1).count()
        discard(now)
        if not moved:
            return after.drop("__moved")
        now = written(after.drop("__moved"), "roots")
        discard(after)


def spelling_variants(docs: DataFrame, letters: int = WORD_LETTERS, count: int = WORD_COUNT, times: int = FORM_TIMES, every: int = ERROR_EVERY) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (see `word_counts`).

    n_near counts the words one code point away. Of these a word's form is the one of largest n (ties: the smallest in code-point order), if
    that is at least `times` its own n, else null; form_n is that form's n. root is where following the forms ends, the word itself where
    there is none. Null and empty texts have no words; repeated rows count each time; an empty table gives an empty one; other columns are not read.
    """
    # Ids ascend with the words, so the smallest id is the smallest word.
    words = written(word_counts(docs, letters, count, every).orderBy("word").select(F.monotonically_increasing_id().alias("word_id"), "word", "n"), "words")
    pairs = written(near_pairs(words, gram_dictionary(words)), "near")
    both = pairs.select(F.col("a").alias("word_id"), "n_a", F.col("b").alias("other"), F.col("n_b").alias("other_n")).union(pairs.select("b", "n_b", "a", "n_a"))
    degree = both.groupBy("word_id").agg(F.count("*").alias("n_near"))
    best = F.max(F.struct("other_n", (-F.col("other")).alias("id")))
    forms = written(both.where(F.col("other_n") >= F.col("n_a") * times).groupBy("word_id").agg(best.alias("f")).select("word_id", (-F.col("f.id")).alias("form_id"), F.col("f.other_n").alias("form_n")), "forms")
    told = forms.join(roots(forms), "word_id")
    name = lambda as_id, out: words.select(F.col("word_id").alias(as_id), F.col("word").alias(out))
    told = told.join(name("form_id", "form"), "form_id").join(name("root_id", "root"), "root_id").select("word_id", "form", "root", "form_n")
    out = words.join(degree, "word_id", "left").join(told, "word_id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


#: The contract in SQL. crc32 goes byte by byte over a table made here; near words meet without one letter, or as one of them is the other without one.
ORACLE = r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS b FROM each),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda s, x: xor(t[xor(s, x) % 256 + 1], s // 256)), 4294967295) AS h FROM bytes, crc),
said AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gone AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.l = b.l AND a.r = b.r AND a.i = b.i AND a.word <> b.word
    UNION SELECT g.word, g.n, w.word, w.n FROM gone g JOIN words w ON w.word = g.l || g.r UNION SELECT w.word, w.n, g.word, g.n FROM gone g JOIN words w ON w.word = g.l || g.r),
degree AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT word, other AS form, other_n AS form_n FROM near WHERE other_n >= 10 * n QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
steps AS (SELECT word, form AS so_far, 1 AS k FROM forms UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN forms f ON f.word = s.so_far),
ends AS (SELECT word, arg_max(so_far, k) AS root FROM steps GROUP BY word)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(d.n_near, 0) AS n_near, f.form_n FROM words w LEFT JOIN degree d ON d.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN ends e ON e.word = w.word"""
