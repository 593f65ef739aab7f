"""Queries of the readers of the published relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions.expr import ratio, seconds
from spanlake.operators import windows

BAND_MS = 2_000


def leaders(scorecard: DataFrame) -> DataFrame:
    """One run for each card: most kills, fastest 50, best rate, longest. Ties go to the smaller run_id."""
    card = lambda name, value, up: F.struct(F.lit(name).alias("card"), *[F.max_by(F.struct("run_id", "character_key", F.col(value).cast("double").alias("value")), F.when(F.col(value).isNotNull(), F.struct(F.col(value) * (1 if up else -1), _reversed("run_id")))).alias("best")])
    cards = scorecard.agg(F.array(card("most kills", "kills", True), card("fastest 50 kills", "t_50_kills_s", False), card("best rate", "kills_per_min", True), card("longest run", "duration_s", True)).alias("c"))
    return cards.select(F.inline("c")).select("card", "best.*")


def _reversed(text: str) -> Column:
    """A key that falls as the text rises."""
    return F.translate(F.hex(F.col(text)), "0123456789ABCDEF", "FEDCBA9876543210")


def replay(pulses: DataFrame) -> DataFrame:
    """Pulses against the time since their run began, of runs with a kill."""
    span = pulses.groupBy("run_id").agg(F.min("srv").alias("s0"), F.max("kills").alias("most")).where("most > 0")
    return pulses.join(span, "run_id").select("run_id", seconds(F.col("srv") - F.col("s0")).alias("t_s"), "state", "kills", "hp")


def phase_bands(pulses: DataFrame, phase: Column, by: list[str] = ("run_id",), order: str = "srv", reach: int = BAND_MS) -> DataFrame:
    """Neighbouring pulses of one phase as bands; pulses without a phase are skipped, and a band reaches over them for `reach`."""
    phased = pulses.withColumn("phase", phase).where("phase IS NOT NULL")
    numbered = windows.bands(phased, "phase", list(by), order, reach, "band")
    return numbered.groupBy(*by, "band", "phase").agg(F.min(order).alias("started"), F.max(order).alias("ended"), F.count("*").alias("pulses"))


def burst_shares(bursts: DataFrame, streaks: DataFrame) -> DataFrame:
    """Share of kills that came with others, in bursts and in streaks."""
    one = lambda rows, name: rows.agg(F.lit(name).alias("kind"), F.count("*").alias("groups"), F.count_if(F.col("kills") > 1).alias("multi"), F.sum("kills").alias("kills"), F.sum(F.when(F.col("kills") > 1, F.col("kills")).otherwise(0)).alias("kills_in_multi"))
    return one(bursts, "burst").unionByName(one(streaks, "streak")).withColumn("share", F.round(ratio(F.col("kills_in_multi"), F.col("kills")), 4))


def kills_by_burst_size(bursts: DataFrame) -> DataFrame:
    return bursts.groupBy(F.col("kills").alias("size")).agg(F.count("*").alias("bursts"), F.sum("kills").alias("kills"))


def bursts_by_character(bursts: DataFrame) -> DataFrame:
    return bursts.groupBy("character_key").agg(F.count("*").alias("bursts"), F.max("kills").alias("biggest"), F.round(F.avg("kills"), 2).alias("average"), F.max_by("span_ms", "kills").alias("biggest_span_ms"))


def agreement(reconciled: DataFrame) -> DataFrame:
    gap = F.abs("events_minus_counter")
    return reconciled.agg(F.count_if(F.col("agrees")).alias("agree"), F.count_if(~F.col("agrees")).alias("disagree"), F.max(gap).alias("worst"))


def funnel_percent(steps: DataFrame, count: str = "runs") -> DataFrame:
    """Each step as a share of the first and of the one before. A row a step."""
    window = windows.ordered([], "step_seq")
    first = F.first(count).over(window)
    return steps.withColumns({"pct_of_first": F.round(100 * ratio(F.col(count), first), 1), "pct_of_previous": F.round(100 * ratio(F.col(count), F.lag(count).over(window)), 1)})


def fight_share(encounters: DataFrame, runs: DataFrame, boss: str) -> DataFrame:
    fights = encounters.where(F.col("boss_key") == boss).groupBy("run_id").agg(F.sum("kills_during").alias("kills_in_fight"))
    return fights.join(runs.select("run_id", "character_key", "kills"), "run_id").withColumn("share", F.round(ratio(F.col("kills_in_fight"), F.col("kills")), 4))


def miss_rate(combat: DataFrame) -> DataFrame:
    """Misses a shot, null where a character has no miss event at all (then misses weren't logged)."""
    return combat.select("character_key", "shots", "misses", F.when(F.col("misses") > 0, F.round(ratio(F.col("misses"), F.col("shots")), 4)).alias("miss_rate"))


def boss_totals(by_kind: DataFrame) -> DataFrame:
    return by_kind.agg(*[F.sum(c).alias(c) for c in ("encounters", "progressed", "died", "won", "unresolved")])


def labelled_gaps(gaps: DataFrame) -> DataFrame:
    return gaps.withColumn("label", F.concat(F.coalesce("prev_vis", F.lit("none")), F.lit(" -> "), F.coalesce("vis", F.lit("none"))))


def formatted(rows: DataFrame, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return rows.withColumn(column, F.date_format(column, pattern))


def listed(rows: DataFrame, column: str, by: str = ", ") -> DataFrame:
    return rows.withColumn(column, F.array_join(column, by))


def top(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(k)
