"""Sequencing operators. Column names are parameters, so the same code serves wire logs and any other table.

Orders put nulls last. Every operator needs its rows dealt by `by` alone, so several in a row share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(by: list[str], *order: str):
    return Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_count(flag: Column, by: list[str], *order: str) -> Column:
    """How many rows up to this one have the flag."""
    return F.sum(F.when(flag, 1).otherwise(0)).over(_running(ordered(by, *order))).cast("int")


def rank_by_first_seen(rows: DataFrame, by: list[str], member: str, order: str, out: str) -> DataFrame:
    """Number the members of each group by when they were first seen; members first seen together share a number."""
    first = F.min(order).over(Window.partitionBy(*by, member))
    rank = F.dense_rank().over(Window.partitionBy(*by).orderBy(F.col("__first").asc_nulls_last())).cast("int")
    return rows.withColumn("__first", first).withColumn(out, rank).drop("__first")


def gaps(rows: DataFrame, by: list[str], order: str, more_than: int, carry: list[str] = ()) -> DataFrame:
    """Rows that come more than `more_than` after the one before, with prev_<order> and prev_<carry>."""
    window = ordered(by, order)
    lagged = {f"prev_{c}": F.lag(c).over(window) for c in [order, *carry]}
    return rows.withColumns(lagged).where(F.col(order) - F.col(f"prev_{order}") > more_than)


def held_time(order: str, by: list[str], *ties: str) -> Column:
    """How long each row held until the next, 0 for the last; rows that tie in order go by `ties`."""
    return F.coalesce(F.lead(order).over(ordered(by, order, *ties)) - F.col(order), F.lit(0))


def islands_by_flag(rows: DataFrame, flag: str, by: list[str], order: str, out: str, *ties: str) -> DataFrame:
    """Rows with the flag, numbered by runs of it: a run begins where the row before lacks it. Rows that tie in order go by `ties`."""
    before = F.lag(flag).over(ordered(by, order, *ties))
    edged = rows.withColumn("__opens", F.col(flag) & ~F.coalesce(before, F.lit(False)))
    return edged.withColumn(out, running_count(F.col("__opens"), by, order, *ties)).where(F.col(flag)).drop("__opens")


def islands_by_value(rows: DataFrame, value: str, by: list[str], order: str, out: str) -> DataFrame:
    """Rows numbered by runs of an equal value (null equals null)."""
    window = ordered(by, order)
    opens = F.row_number().over(window) == 1
    changed = ~F.lag(value).over(window).eqNullSafe(F.col(value))
    return rows.withColumn("__opens", opens | changed).withColumn(out, running_count(F.col("__opens"), by, order)).drop("__opens")


def gap_groups(rows: DataFrame, by: list[str], order: str, gap: int, out: str) -> DataFrame:
    """Rows numbered by groups: one opens where the row before is more than `gap` away."""
    before = F.lag(order).over(ordered(by, order))
    opens = before.isNull() | (F.col(order) - before > gap)
    return rows.withColumn("__opens", opens).withColumn(out, running_count(F.col("__opens"), by, order)).drop("__opens")


def with_next(rows: DataFrame, value: str, by: list[str], order: str, out: str, *ties: str) -> DataFrame:
    """Each row with the value of the row after it: what follows a bound is read off the bound's last row, without a
    range join. Right where `order` and `ties` are unique within `by`."""
    return rows.withColumn(out, F.lead(value).over(ordered(by, order, *ties)))


def bands(rows: DataFrame, kind: str, by: list[str], order: str, reach: int, out: str) -> DataFrame:
    """Rows numbered by bands: neighbours of one kind within `reach` of the row before are one band."""
    window = ordered(by, order)
    same = F.lag(kind).over(window).eqNullSafe(F.col(kind)) & (F.col(order) - F.lag(order).over(window) <= reach)
    return rows.withColumn("__opens", ~F.coalesce(same, F.lit(False))).withColumn(out, running_count(F.col("__opens"), by, order)).drop("__opens")


def version_sequence(rows: DataFrame, key: list[str], valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """version_seq and is_current of each version of a member."""
    return rows.withColumn("version_seq", F.row_number().over(ordered(key, valid_from)).cast("int")).withColumn("is_current", F.col(valid_to).isNull())
