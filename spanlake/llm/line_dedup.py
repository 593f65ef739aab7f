"""Removal of repeated runs of lines, with DataFrame operations only.

The corpus is a set of line-id sequences. Prefix doubling ranks, for each length 1, 2, 4, ..., the runs of so many
lines that stand at two places at least: a run of twice the length is the pair of the ranks of its halves, and ranks keep
the order of the line ids, as in a suffix array. The places of one rank are an interval of suffixes whose longest
common prefix reaches that length. Places that share their run with no other drop out, so each round works
on fewer of them, and doubling ends when no run repeats. An interval's first place keeps its run, its later copies are
deleted, each by the longest interval that it is a later copy in.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.scratch import discard, unused, written

KEY = ["doc", "text_hash"]


def line_ids(docs: DataFrame) -> DataFrame:
    """doc, text_hash, ids: the 64-bit ids of each text's lines in order. Rows of one id and text are one document."""
    slim = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"),
        F.transform(F.split("text", "\n", -1), lambda line: F.xxhash64(line)).alias("ids"),
    )
    return slim.dropDuplicates(KEY)


def _repeated(runs: DataFrame, names: list[str]) -> DataFrame:
    """The names that at least two positions have, with the first of these. To be written before a join with the positions: that
    reads two plain shuffles then, and Spark can split a very common name over tasks."""
    place = F.struct(F.col("doc").isNull().alias("unknown"), "doc", "text_hash", "at")
    return runs.groupBy(*names).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")


def _is_copy():
    return ~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("at") == F.col("first.at")))


def _paired(runs: DataFrame, gap: int) -> DataFrame:
    """Each run with the name of the run that begins `gap` lines later in its document."""
    later = runs.select(F.col("doc").alias("doc_2"), F.col("text_hash").alias("hash_2"), (F.col("at") - gap).alias("at_2"), F.col("head").alias("head_2"), F.col("rank").alias("rank_2"))
    same = F.col("doc").eqNullSafe(F.col("doc_2")) & (F.col("text_hash") == F.col("hash_2")) & (F.col("at") == F.col("at_2"))
    return runs.join(later, same).select(*KEY, "at", "head", "rank", "head_2", "rank_2")


def _named(pairs: DataFrame) -> DataFrame:
    """The pairs that repeat, under one rank each, in the order of the ranks of their halves. A sort by ranges gives the ranks:
    the number of a row in its range and of the range are one long, so no task sorts all, and they are written, so they stay."""
    names, pairs = ["head", "rank", "head_2", "rank_2"], written(pairs, "pairs")
    ordered = _repeated(pairs, names).repartitionByRange(*names).sortWithinPartitions(*names)
    ranked = written(ordered.withColumn("new_rank", F.monotonically_increasing_id()), "ranks")
    runs = written(pairs.join(ranked, names).select(*KEY, "at", "head", F.col("new_rank").alias("rank"), "first"), "runs")
    discard(pairs)
    discard(ranked)
    return runs


def intervals(docs: DataFrame, lines: int = 1) -> Iterator[tuple[int, DataFrame]]:
    """(length, places) for `lines` and each length 2 ** k above it, until no run of the length repeats. places: doc, text_hash,
    at, first: where a run of exactly so many lines begins that stands at two places at least, and its first place by doc_id
    (a null id last), text hash and line number."""
    ids = line_ids(docs).select(*KEY, F.posexplode("ids").alias("at", "head")).withColumn("rank", F.lit(0).cast("long"))
    runs, length = written(ids.join(written(_repeated(ids, ["head"]), "names"), "head").select(*KEY, "at", "head", "rank", "first"), "runs"), 1
    while not runs.isEmpty():
        if length >= lines:
            yield length, runs
        elif length * 2 > lines:
            yield lines, _named(_paired(runs, lines - length))
        runs, length = _named(_paired(runs, length)), length * 2


def copied_runs(docs: DataFrame, lines: int) -> DataFrame:
    """doc, text_hash, at, length, first: each place where a run of `lines` lines or more begins that stood before, with the
    greatest length asked for in `intervals` at which it did, and the first place of that run."""
    found = None
    for length, places in intervals(docs, lines):
        copies = places.where(_is_copy()).select(*KEY, "at", F.lit(length).alias("length"), "first")
        found = copies if found is None else found.union(copies)
    if found is None:
        empty = "doc long, text_hash long, at int, length int, first struct<unknown: boolean, doc: long, text_hash: long, at: int>"
        return docs.sparkSession.createDataFrame([], empty)
    longest = F.max(F.struct("length", "first")).alias("run")
    return found.groupBy(*KEY, "at").agg(longest).select(*KEY, "at", "run.length", "run.first")


def repeated_lines(docs: DataFrame, words: int) -> DataFrame:
    """doc, text_hash, at, first: every line of at least `words` words that stands at two places at least. Lines are compared
    by 128 bits, as one line alone has no neighbour that would have to collide too."""
    enough = rf"(\S+\s+){{{words - 1}}}\S"
    slim = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"),
        F.transform(F.split("text", "\n", -1), lambda line: F.when(line.rlike(enough), F.struct(F.xxhash64(line).alias("head"), F.xxhash64(F.lit(1), line).alias("head_2")))).alias("ids"),
    )
    lines = slim.dropDuplicates(KEY).select(*KEY, F.posexplode("ids").alias("at", "id")).where("id IS NOT NULL").select(*KEY, "at", "id.head", "id.head_2")
    return lines.join(written(_repeated(lines, ["head", "head_2"]), "names"), ["head", "head_2"]).select(*KEY, "at", "first")


def deleted_ranges(docs: DataFrame, lines: int, line_words: int | None = None) -> DataFrame:
    """doc, text_hash, starts, ends, n_deleted, longest: the maximal ranges of lines (ends not included) that later copies cover,
    and the greatest length of a run among them."""
    copies = copied_runs(docs, lines).select(*KEY, "at", "length")
    if line_words is not None:
        copies = copies.union(repeated_lines(docs, line_words).where(_is_copy()).select(*KEY, "at", F.lit(1)))
    copies = copies.withColumn("stop", F.col("at") + F.col("length"))
    order = Window.partitionBy(*KEY).orderBy("at", "stop")
    edge = F.coalesce(F.col("at") > F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    islands = copies.withColumn("edge", edge.cast("int")).withColumn("island", F.sum("edge").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranges = islands.groupBy(*KEY, "island").agg(F.min("at").alias("begin"), F.max("stop").alias("end"), F.max("length").alias("length"))
    per_doc = ranges.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("ranges"), F.max("length").alias("longest"))
    return per_doc.select(*KEY, F.col("ranges.begin").alias("starts"), F.col("ranges.end").alias("ends"), F.aggregate("ranges", F.lit(0), lambda n, r: n + (r["end"] - r["begin"]).cast("int")).alias("n_deleted"), "longest")


def dedup_lines(docs: DataFrame, lines: int = 2, line_words: int | None = None) -> DataFrame:
    """`docs` with text less each run of at least `lines` (2 or more) lines that stood before, plus n_lines, n_deleted and
    longest_run: the greatest of the lengths `lines` and 2 ** k above it at which a run of the text stood before (a single line: 1), or 0.
    With `line_words`, a single line of at least so many words (1 or more) that stood before goes too, whatever its neighbours.

    Lines end at a line feed and are equal when their bytes are. The first place of a run, by doc_id and then line number,
    keeps it; in one text a second copy goes too. Null texts stay null with 0 lines, an empty text is one
    empty line. Rows of the same doc_id and text are one document and come out alike; among different texts of one id
    the text's hash decides. A null doc_id comes last. Every row stays, even where no line is left (empty text); all other
    columns are kept, and an empty table gives an empty one.
    """
    if lines < 2:
        raise ValueError("runs have two lines or more")
    if line_words is not None and line_words < 1:
        raise ValueError("line_words must be positive")
    gone = deleted_ranges(docs, lines, line_words)
    key = unused(docs, "doc", "text_hash", "starts", "ends", "n", "lines", "longest")
    gone = gone.select(F.col("doc").alias(key["doc"]), F.col("text_hash").alias(key["text_hash"]), F.col("starts").alias(key["starts"]), F.col("ends").alias(key["ends"]), F.col("n_deleted").alias(key["n"]), F.col("longest").alias(key["longest"]))
    same = docs["doc_id"].cast("long").eqNullSafe(gone[key["doc"]]) & (F.xxhash64(docs["text"]) == gone[key["text_hash"]])
    joined = docs.join(gone, same, "left").withColumn(key["lines"], F.split("text", "\n", -1))
    split = F.col(key["lines"])
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.col(key["ends"]).cast("array<int>")).alias("from"),
        F.concat(F.col(key["starts"]).cast("array<int>"), F.array(F.size(split))).alias("to"),
    )
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(split, g["from"] + 1, g["to"] - g["from"])))
    text = F.when(F.col(key["starts"]).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split))
    out = joined.withColumns({"n_lines": n_lines, "n_deleted": F.coalesce(F.col(key["n"]), F.lit(0)), "longest_run": F.coalesce(F.col(key["longest"]), F.lit(0))})
    return out.withColumn("text", text).drop(*key.values())


ORACLE = """
WITH texts AS (
    SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM texts
), starts AS (
    SELECT l.doc_id, l.pos, k.n AS len, md5(array_to_string(list_slice(t.ls, l.pos, l.pos + k.n - 1), chr(10))) AS run
    FROM lines l JOIN texts t USING (doc_id) JOIN (SELECT CAST(2 ** unnest(range(1, 16)) AS BIGINT) AS n) k ON l.pos + k.n - 1 <= len(t.ls)
), copies AS (
    SELECT doc_id, pos, len, row_number() OVER (PARTITION BY len, run ORDER BY doc_id, pos) > 1 AS is_copy FROM starts
), gone AS (
    SELECT DISTINCT doc_id, unnest([pos, pos + 1]) AS pos FROM copies WHERE is_copy AND len = 2
), longest AS (
    SELECT doc_id, max(len) AS n FROM copies WHERE is_copy GROUP BY doc_id
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_deleted,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_deleted, 0) AS INTEGER) AS n_deleted,
    CAST(coalesce(m.n, 0) AS INTEGER) AS longest_run, md5(k.text) AS text_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN longest m ON m.doc_id = d.doc_id
"""
