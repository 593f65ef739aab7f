"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

A document's features are its distinct words and their beginnings. The fit takes a bounded sample of labelled
rows: features that mark toxic rows are chosen by their log odds, toxic rows get a grade (1 mild to 3 severe) by how
many distinct marking words they hold, and one set of weights w with ordered thresholds is fitted to
P(grade >= k) = sigmoid(w x - threshold k). Scoring sums one number for each distinct word of a text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.chunks import release, slices
from spanlake.llm.scratch import unused

SAMPLE_ROWS = 20_000
FEATURES = 2_048
CANDIDATES = 20_480
LEAST_ROWS = 4
GRADES = 3
REJECT = 0.5
LETTERS = re.compile(r"[^\W\d_]+")
#: A longer word is named by its beginning and a digest of the whole.
WORD_CHARS = 64


def features_of(token: str) -> list[str]:
    """Words of letters in the token, and their beginnings of 5 to 8 letters (marked by a star)."""
    out = []
    for word in LETTERS.findall(token.lower()):
        out.append(word if len(word) <= WORD_CHARS else f"{word[:8]}-{hashlib.blake2b(word.encode(), digest_size=16).hexdigest()}")
        out += [word[:n] + "*" for n in range(5, min(8, len(word)) + 1)]
    return out


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Each text's distinct tokens between spaces: (text, token) numbers, and the tokens."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, "").cast(pa.string()))
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lists.value_lengths().to_numpy())
    full = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
    both = np.unique((row * max(1, len(coded.dictionary)) + coded.indices.to_numpy())[full])
    return *np.divmod(both, max(1, len(coded.dictionary))), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


@dataclass
class Model:
    """weights: of each feature; thresholds ascend, one for each grade; length: weight of log(1 + distinct tokens)."""

    weights: dict[str, float]
    thresholds: np.ndarray
    length: float

    def severity(self, score: np.ndarray) -> np.ndarray:
        """Expected grade: the sum over grades of the chance to reach them."""
        return _sigmoid(score[:, None] - self.thresholds[None, :]).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


#: Lists of the features of all tokens stand in memory while a model is fitted, so the parts are small.
FIT_BYTES = 1 << 20


def _counted(wanted=None):
    """mapInArrow: in how many rows each feature stands; with `wanted` only these features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Counter = Counter()
        only = wanted.value if wanted else None
        for batch in batches:
            for part in slices(batch, "text", FIT_BYTES):
                row, token, tokens = tokens_of(part.column("text"))
                known = [features_of(t) if only is None else [f for f in features_of(t) if f in only] for t in tokens]
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                for i in range(part.num_rows):
                    rows.update({f for t in token[bounds[i] : bounds[i + 1]].tolist() for f in known[t]})
        names = list(rows)
        for lo in range(0, len(names), 50_000):
            part = names[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([rows[x] for x in part], pa.int64())], ["feature", "n"])
        rows.clear()
        release()

    return run


def _vectors(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = chosen.value
        for batch in batches:
            for part in slices(batch, "text", FIT_BYTES):
                row, token, tokens = tokens_of(part.column("text"))
                known = [[number[f] for f in features_of(t) if f in number] for t in tokens]
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                held = [[f for t in token[a:b].tolist() for f in known[t]] for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(np.diff(bounds), pa.int64()), pa.array(held, pa.list_(pa.int32()))], ["toxic", "n", "features"])

    return run


def fit_ordinal(grade: np.ndarray, indices: np.ndarray, pointers: np.ndarray, dense: np.ndarray, width: int, steps: int = 400, ridge: float = 2e-3) -> tuple[np.ndarray, np.ndarray, float]:
    """Cumulative-link regression by Adam: shared weights of the sparse counts and of one dense column, ordered thresholds.

    Thresholds are the first plus exponentials, so they stay in order. Returns weights, thresholds, the dense weight."""
    k = int(grade.max())
    row = np.repeat(np.arange(len(grade)), np.diff(pointers))
    x = np.zeros(width + 1 + k)
    x[width + 1] = 2.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, d, raw = x[:width], x[width], x[width + 1 :]
        gaps = np.exp(np.clip(raw[1:], -8, 8))
        theta = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, w[indices], len(grade)) + d * dense
        reach = np.concatenate([np.ones((len(grade), 1)), _sigmoid(eta[:, None] - theta), np.zeros((len(grade), 1))], axis=1)
        slope = reach * (1 - reach)
        at = np.arange(len(grade))
        chance = np.maximum(reach[at, grade] - reach[at, grade + 1], 1e-12)
        d_eta = -(slope[at, grade] - slope[at, grade + 1]) / chance / len(grade)
        d_theta = np.zeros(k + 2)
        np.add.at(d_theta, grade, slope[at, grade] / chance / len(grade))
        np.add.at(d_theta, grade + 1, -slope[at, grade + 1] / chance / len(grade))
        d_theta = d_theta[1 : k + 1]
        later = np.cumsum(d_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(indices, d_eta[row], width) + ridge * w / 10, [d_eta @ dense + ridge * d / 10], [later[0]], later[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = x[width + 1 :]
    return x[:width], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(raw[1:], -8, 8)))]), float(x[width])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model | None:
    """Fit on at most `sample_rows` labelled rows (smallest hashes of doc_id); None if they lack toxic or clean rows.

    Of rows with the same doc_id one counts, that of the least text; a doc_id with several labels is toxic if one says so. Null ids, texts
    and labels other than 0 and 1 take no part. Only that sample, its chosen features and the counts of these come to the driver, all
    bounded by the parameters.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic").persist()
    try:
        total = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        toxic, clean = total.get(1, 0), total.get(0, 0)
        if not toxic or not clean:
            return None
        # Features of toxic rows first, the most frequent of them; clean rows are then searched for these alone.
        count = lambda rows, run: rows.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        often = count(sample.where("toxic = 1"), _counted()).where("n > 1").orderBy(F.desc("n"), "feature").limit(CANDIDATES).persist()
        wanted = spark.sparkContext.broadcast({r["feature"] for r in often.collect()})
        cleaner = count(sample.where("toxic = 0"), _counted(wanted)).withColumnRenamed("n", "clean")
        counts = often.withColumnRenamed("n", "toxic").join(cleaner, "feature", "left").fillna(0, ["clean"])
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
        best = counts.where(F.col("toxic") + F.col("clean") >= LEAST_ROWS).withColumn("odds", odds).where("odds > 1.5").withColumn("gain", F.col("odds") * F.col("toxic"))
        top = best.orderBy(F.desc("gain"), "feature").limit(features).collect()
        if not top:
            return None
        number = {r["feature"]: i for i, r in enumerate(top)}
        marks = np.array([not r["feature"].endswith("*") and r["odds"] > 3 for r in top])
        rows = sample.mapInArrow(_vectors(spark.sparkContext.broadcast(number)), "toxic int, n long, features array<int>").collect()
        often.unpersist()
    finally:
        sample.unpersist()
    held = [np.asarray(r["features"], np.int64) for r in rows]
    is_toxic = np.array([r["toxic"] for r in rows])
    hits = np.array([int(marks[h].sum()) for h in held])
    cuts = np.quantile(hits[is_toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(is_toxic == 1, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)
    grade = np.searchsorted(np.unique(grade), grade)  # no empty grades
    dense = np.log1p(np.array([r["n"] for r in rows], np.float64))
    center = float(dense.mean())
    pointers = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    w, theta, d = fit_ordinal(grade, np.concatenate(held) if pointers[-1] else np.zeros(0, np.int64), pointers, dense - center, len(number))
    return Model({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-4}, theta + d * center, d)


def _scored(model, names: dict[str, str], reject: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        get = m.weights.get if m else None
        for batch in batches:
            for part in slices(batch, "text", 2 * FIT_BYTES):
                expected = np.zeros(part.num_rows)
                if m:
                    row, token, tokens = tokens_of(part.column("text"))
                    worth = np.fromiter((sum(get(f, 0.0) for f in features_of(t)) for t in tokens), np.float64, len(tokens))
                    n = np.bincount(row, minlength=part.num_rows)
                    score = np.bincount(row, worth[token], part.num_rows) + m.length * np.log1p(n)
                    expected = np.where(n > 0, m.severity(score), 0.0)
                out = part.append_column(names["severity"], pa.array(expected))
                out = out.append_column(names["grade"], pa.array(np.rint(expected).astype(np.int32)))
                yield out.append_column(names["toxic"], pa.array(expected >= reject))

    return run


def score(docs: DataFrame, model: Model | None, reject: float = REJECT) -> DataFrame:
    """`docs` with severity (expected grade), grade (the nearest) and toxic (severity >= reject).

    Every row and column stays; null and empty texts, and all rows without a model, have severity 0. Where `docs` has
    a column of one of these names it stays and the new one gets underscores before its name. Whole texts
    count, each distinct token once.
    """
    free = unused(docs, "severity", "grade", "toxic")
    taken = {c.lower() for c in docs.columns}
    names = {k: k if k not in taken else v for k, v in free.items()}
    fields = T.StructType([*docs.schema.fields, T.StructField(names["severity"], T.DoubleType()), T.StructField(names["grade"], T.IntegerType()), T.StructField(names["toxic"], T.BooleanType())])
    return docs.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model), names, reject), fields)


def accuracy(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """rows, right, found, missed, wrongly: how `toxic` of scored rows agrees with labels."""
    both = scored.select("doc_id", F.col("toxic").alias("said")).join(labels.select("doc_id", (F.col("toxic") == 1).alias("is")), "doc_id")
    said, true = F.col("said"), F.col("is")
    return both.agg(F.count("*").alias("rows"), F.count_if(said == true).alias("right"), F.count_if(said & true).alias("found"), F.count_if(~said & true).alias("missed"), F.count_if(said & ~true).alias("wrongly"))
