"""Language of a text by a string kernel.

Two texts are as alike as the share of n-grams of 1 to SPECTRUM letters that both hold (blended spectrum, each gram counted once, among the grams
of the landmarks). A bounded sample of labelled rows gives the landmarks, whose kernel with a text, put through the Nystroem map, are the
text's features; one ridge regression a language tells that language from the rest. A batch of texts is scored by matrix products:
its grams by the landmarks' grams, then the kernel by the weights.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.chunks import release, slices
from spanlake.llm.scratch import small_batches, unused

SPECTRUM = 4
#: Labelled rows of each language that the fit takes at most, and how many of them are landmarks.
SAMPLE_ROWS, LANDMARKS = 2_000, 32
#: Landmarks are texts of no more letters (any text may be scored or fitted on).
LANDMARK_CHARS = 4_000
#: Languages that are told apart at most: each costs a sample and landmarks, so more are an error and not cut.
LANGUAGES = 256
RIDGE = 1e-3
FOLDS, UNKNOWN = 5, "und"
#: Texts scored by one product, and the letters that they may hold together unless one text holds more.
_ROWS, _LETTERS = 128, 1 << 20
_BITS = 16


@functools.cache
def _letters() -> np.ndarray:
    """Of each code point: 1 for a letter, else 0."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def normal_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the lower-case texts, one after another, and whose each is. Each run of what isn't a letter is one space, and a space
    stands at both ends of each text, so two in a row stand only between texts."""
    lower = [f" {t.lower()} " for t in texts]
    lengths = np.fromiter(map(len, lower), np.int64, len(lower))
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[np.cumsum(lengths) - lengths] = True
    return np.where(letter, points, np.uint32(0x20))[kept], np.repeat(np.arange(len(lower)), lengths)[kept]


def gram_codes(points: np.ndarray, spectrum: int) -> Iterator[np.ndarray]:
    """For each length up to `spectrum` a number for the gram that begins at each place. Grams of up to four letters below 2^16 have numbers of
    their own; others have 64 bits that seldom meet."""
    low = (points & np.uint32(0xFFFF)).astype(np.uint64) ^ (points >> np.uint32(16)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    codes = low
    for n in range(1, spectrum + 1):
        if n > 1:
            codes = (codes[:-1] << np.uint64(_BITS) | codes[:-1] >> np.uint64(64 - _BITS)) ^ low[n - 1 :]
        yield codes


class Places:
    """Where each of a set of numbers stands: a table by hash, and the few that share a slot in order."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.shift = np.uint64(64 - max(10, min(22, int(np.ceil(np.log2(max(1, len(numbers))))) + 6)))
        self.table = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        slots = self._slots(numbers)
        self.table[slots] = np.arange(len(numbers))
        rest = np.flatnonzero(self.table[slots] != np.arange(len(numbers)))
        self.rest = rest[np.argsort(numbers[rest])]

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are in the set, and where each of those stands."""
        if not len(self.numbers):
            return np.zeros(len(codes), bool), np.zeros(0, np.int64)
        at = self.table[self._slots(codes)].astype(np.int64)
        is_in = (at >= 0) & (self.numbers[at] == codes)
        if len(self.rest):
            missed = np.flatnonzero(~is_in & (at >= 0))
            k = self.rest[np.minimum(np.searchsorted(self.numbers[self.rest], codes[missed]), len(self.rest) - 1)]
            right = self.numbers[k] == codes[missed]
            at[missed[right]], is_in[missed[right]] = k[right], True
        return is_in, at[is_in]


@dataclass
class Model:
    """languages ascend; grams: for each length the numbers of all grams of the landmarks, ascending; presence: (grams, landmarks), 1 where
    the landmark holds it; held: grams of each landmark; weights: (landmarks, languages)."""

    languages: list[str]
    grams: list[np.ndarray]
    presence: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        self.held = self.presence.sum(axis=0, dtype=np.float64)
        self.starts = np.concatenate([[0], np.cumsum([len(g) for g in self.grams])])
        self.places = [Places(g) for g in self.grams]

    def kernel(self, texts: list[str]) -> np.ndarray:
        """(texts, landmarks): shared grams over the geometric mean of both texts' grams, among the grams of all landmarks."""
        points, row = normal_points(texts)
        width = int(self.starts[-1])
        holds = np.zeros(len(texts) * width, np.float32)
        # A gram that reaches into the next text has two spaces in a row, as no gram of a landmark has.
        for n, codes in enumerate(gram_codes(points, len(self.grams))):
            is_in, at = self.places[n].find(codes)
            holds[row[: len(codes)][is_in] * width + self.starts[n] + at] = 1
        holds = holds.reshape(len(texts), width)
        size = holds.sum(axis=1, dtype=np.float64)
        return (holds @ self.presence).astype(np.float64) / np.sqrt(np.maximum(size, 1)[:, None] * self.held[None, :])

    def decide(self, kernel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language's place and its score: the regression's 1 and -1 as 1 and 0. Ties go to the language that comes first."""
        values = kernel @ self.weights
        best = values.argmax(axis=1)
        return best, np.clip((1 + values[np.arange(len(values)), best]) / 2, 0, 1)


def landmark_model(languages: list[str], landmarks: list[str], spectrum: int = SPECTRUM) -> Model:
    """A model without weights yet."""
    each = [[np.unique(codes) for codes in gram_codes(normal_points([t])[0], spectrum)] for t in landmarks]
    grams = [np.unique(np.concatenate([e[n] for e in each])) for n in range(spectrum)]
    starts = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
    presence = np.zeros((int(starts[-1]), len(landmarks)), np.float32)
    for j, found in enumerate(each):
        for n, codes in enumerate(found):
            presence[starts[n] + np.searchsorted(grams[n], codes), j] = 1
    return Model(languages, grams, presence, np.zeros((len(landmarks), len(languages))))


def fit_ridge(model: Model, among: np.ndarray, kernel: np.ndarray, language: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the landmarks: ridge regression of 1 and -1 for each language on Nystroem features. `among`: the landmarks' kernel with each
    other; every language weighs the same, however many rows it has."""
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    strong = values > 1e-8 * values.max()
    to_features = vectors[:, strong] / np.sqrt(values[strong])
    features = kernel @ to_features
    rows = np.bincount(language, minlength=len(model.languages))
    weight = 1.0 / (rows[language] * max(1, (rows > 0).sum()))
    target = np.where(language[:, None] == np.arange(len(model.languages)), 1.0, -1.0)
    normal = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    return to_features @ np.linalg.solve(normal, features.T @ (target * weight[:, None]))


def _groups(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and texts of those with a letter; a bounded number at a time."""
    places, held, letters = [], [], 0
    for i, text in enumerate(texts):
        if text and any(map(str.isalpha, text)):
            places.append(i)
            held.append(text)
            letters += len(text)
            if len(places) == _ROWS or letters > _LETTERS:
                yield places, held
                places, held, letters = [], [], 0
    if places:
        yield places, held


def _kernels(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                language = part.column("language")
                for places, texts in _groups(part.column("text").to_pylist()):
                    rows = m.kernel(texts)
                    yield pa.RecordBatch.from_arrays([language.take(pa.array(places)), pa.array(list(rows), pa.list_(pa.float64()))], ["language", "kernel"])
        release()

    return run


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS, spectrum: int = SPECTRUM, ridge: float = RIDGE) -> Model | None:
    """A model of the non-null values of `lang`, by text alone; None where no row has both a language and a letter.

    Of each language about `sample_rows` different texts take part and `landmarks` of them are landmarks, those of least hash, so any order of rows gives the same
    model. Landmark texts and kernels of the sample come to the driver, bounded by these parameters and LANDMARK_CHARS.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(F.col("lang").cast("string").alias("lang"), "text")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return None
    languages = sorted(counts)
    # The share of texts that a language needs, by hash: no sort. Copies of one text are one row of the sample, however many there are.
    hashed = known.withColumn("__h", F.xxhash64("text"))
    limit = lambda n: min(2**63 - 1, int((min(1.0, sample_rows / n) * 2 - 1) * 2.0**63))
    chosen = functools.reduce(lambda a, b: a | b, [(F.col("lang") == lang) & (F.col("__h") <= F.lit(limit(n))) for lang, n in counts.items()])
    sample = hashed.where(chosen).groupBy("lang", "__h").agg(F.first("text").alias("text")).persist()
    try:
        marks = []
        for lang in languages:
            few = sample.where((F.col("lang") == lang) & (F.length("text") <= LANDMARK_CHARS)).orderBy(F.length("text") < 200, "__h").limit(landmarks)
            marks += [r["text"] for r in few.select("text").collect()]
        marks = [t for t in marks if any(map(str.isalpha, t))]
        if not marks:
            return None
        model = landmark_model(languages, marks, spectrum)
        number = F.create_map(*[x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))])
        rows = sample.select(number[F.col("lang")].alias("language"), "text").mapInArrow(_kernels(spark.sparkContext.broadcast(model)), "language int, kernel array<double>").toArrow()
    finally:
        sample.unpersist()
    kernel = rows.column("kernel").combine_chunks().flatten().to_numpy().reshape(-1, len(marks))
    among = model.kernel(marks)
    return Model(languages, model.grams, model.presence, fit_ridge(model, among, kernel, rows.column("language").to_numpy(), ridge))


def _predicted(model, names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                said, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
                if m:
                    for places, texts in _groups(part.column("text").to_pylist()):
                        best, sure = m.decide(m.kernel(texts))
                        said[places], score[places] = [m.languages[k] for k in best], sure
                part = part.append_column(names["lang_pred"], pa.array(said.tolist(), pa.string()))
                yield part.append_column(names["score"], pa.array(score))
        release()

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred and score (0 to 1), from `text` alone.

    Whole texts count, each gram once. Texts without a letter, null and empty ones too, and all texts without a model are `und` with score
    0. Every row and column stays, repeated rows come out alike, and where docs has a column of one of these names it stays and the new one gets
    underscores before its name; an empty table stays empty.
    """
    free, taken = unused(docs, "lang_pred", "score"), {c.lower() for c in docs.columns}
    names = {k: k if k not in taken else v for k, v in free.items()}
    fields = T.StructType([*docs.schema.fields, T.StructField(names["lang_pred"], T.StringType()), T.StructField(names["score"], T.DoubleType())])
    return docs.mapInArrow(_predicted(docs.sparkSession.sparkContext.broadcast(model), names), fields)


def held_out(folds: int = FOLDS):
    """True for rows that no fit may see: by the crc32 of doc_id (a null one counts as an empty one)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model fitted on those not held out."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out()).select("text", "lang"))
    return predict(rows.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def accuracy(predicted: DataFrame, docs: DataFrame) -> DataFrame:
    """held_out, rows, right: how lang_pred agrees with lang."""
    both = predicted.join(docs.where(F.col("lang").isNotNull()).select("doc_id", "lang"), "doc_id")
    return both.groupBy("held_out").agg(F.count("*").alias("rows"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right"))
