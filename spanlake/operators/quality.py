"""Data-quality checks. Each returns the violations, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.operators import ranges
from spanlake.operators.windows import ordered


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def bad_history(versions: DataFrame, key: list[str], first_fact: Column | None = None) -> DataFrame:
    """Members whose versions overlap, end before they begin, have several open versions, or begin after the first fact."""
    window = ordered(key, "valid_from")
    after = F.lead("valid_from").over(window)
    first = F.row_number().over(window) == 1
    marked = versions.select(
        *key, "valid_from", "valid_to",
        (F.col("valid_to") <= F.col("valid_from")).alias("ends_early"),
        (after.isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > after))).alias("overlaps"),
        (first & (F.col("valid_from") > first_fact) if first_fact is not None else F.lit(False)).alias("begins_late"),
    )
    problem = F.when(F.col("ends_early"), "ends before it begins").when(F.col("overlaps"), "overlaps the next version").when(F.col("begins_late"), "begins after the first fact")
    return marked.withColumn("problem", problem).where("problem IS NOT NULL").select(*key, "valid_from", "problem")


def coverage_faults(facts: DataFrame, versions: DataFrame, fact_key: list[str], on: Column, at: Column) -> DataFrame:
    """Facts that find no version in force, or several."""
    in_force = on & (at >= versions["valid_from"]) & (versions["valid_to"].isNull() | (at < versions["valid_to"]))
    return facts.join(versions, in_force, "left").groupBy(*fact_key).agg(F.count("valid_from").alias("versions")).where("versions <> 1")


def overlapping_intervals(rows: DataFrame, by: list[str], start: str, end: str, parts: int | None = None) -> DataFrame:
    """Intervals that begin before an earlier one of their group has ended (ends count in), with the latest end before them. Sorted by ranges,
    with the latest end carried from one to the next, and not paired; a group may be of any size."""
    return ranges.deal(rows, by, start, end, parts=parts).scan(latest_end=ranges.most(F.col(end), inclusive=False)).rows().where(F.col(start) <= F.col("latest_end"))


def orphans(rows: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(parents, key, "left_anti")


def rank_inversions(rows: DataFrame, rank: str, score: str, parts: int | None = None) -> DataFrame:
    """Rows whose score is below that of a worse rank, with the best such score (best_after). The best score of each rank is dealt by ranges and
    written, and the best so far carried from worse ranks to better ones; rows find theirs by their rank. Rows without a rank or score are left out."""
    best = rows.groupBy(F.col(rank).alias("__rank")).agg(F.max(score).alias("__best")).where(F.col("__rank").isNotNull())
    worse = ranges.deal(best, [], ("__rank", True), parts=parts).scan(best_after=ranges.most(F.col("__best"), inclusive=False)).rows()
    out = rows.join(worse, F.col(rank) == F.col("__rank"))
    return out.where(F.col(score) < F.col("best_after")).select(*rows.columns, "best_after")


def conservation(parts: DataFrame, whole: DataFrame, key: list[str], part: str, total: str) -> DataFrame:
    """Keys where the parts don't add up to the whole."""
    added = parts.groupBy(*key).agg(F.sum(part).alias("__sum"))
    both = whole.join(added, key, "full_outer")
    return both.where(~F.coalesce("__sum", F.lit(0)).eqNullSafe(F.coalesce(total, F.lit(0)))).select(*key, F.col("__sum").alias("parts"), F.col(total).alias("whole"))


def drift(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of two domain tables that only one has, with the side."""
    a, b = (x.select(*columns).distinct() for x in (left, right))
    return a.exceptAll(b).withColumn("only_in", F.lit("left")).union(b.exceptAll(a).withColumn("only_in", F.lit("right")))


def insane_runs(runs: DataFrame) -> DataFrame:
    """Runs with negative counts, an end before the start, or more active than wall time."""
    bad = (F.col("kills") < 0) | (F.col("duration_s") < 0) | (F.col("ended_srv") < F.col("started_srv")) | (F.col("sim_active_s") > F.col("duration_s") + 0.05)
    return runs.where(bad)


def values_with(rows: DataFrame, needles: list[str]) -> DataFrame:
    """Rows in which any value at any depth holds one of the strings (withheld origins, say)."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return rows.where(F.exists(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(text, n))) if needles else rows.limit(0)


def digest(rows: DataFrame) -> DataFrame:
    """rows, content, nulls: how many rows, the sum of a 64-bit hash of each row's values as text, and the nulls of each column in the order of the columns.
    The order of rows doesn't count, repeated rows do; one changed cell changes `content`. Columns of plain types only."""
    cells = [F.col(f"`{c}`").cast("string") for c in rows.columns]
    hashed = F.xxhash64(*[F.coalesce(c, F.lit("\x00null")) for c in cells]) if cells else F.lit(0)
    nulls = F.array(*[F.count_if(c.isNull()) for c in cells]).cast("array<bigint>")
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("content"), nulls.alias("nulls"))
