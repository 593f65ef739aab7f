"""Joins over time and membership."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.operators import ranges


def as_of(facts: DataFrame, versions: DataFrame, on: Column, at: Column, valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "inner") -> DataFrame:
    """Facts with the version in force at their time, from valid_from on and before valid_to (null: still in force).

    An equi join on the member with the interval as a condition; Spark broadcasts the versions where they are small.
    """
    in_force = (at >= versions[valid_from]) & (versions[valid_to].isNull() | (at < versions[valid_to]))
    return facts.join(versions, on & in_force, how)


def within(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, slack: int = 0) -> DataFrame:
    """Points in an interval of the same keys, widened by `slack` at both ends. Columns of points come first."""
    p, i = points.alias("p"), intervals.alias("i")
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in on]
    inside = F.col(f"p.{at}").between(F.col(f"i.{start}") - slack, F.col(f"i.{end}") + slack)
    rest = [F.col(f"i.{c}") for c in intervals.columns if c not in on and c not in points.columns]
    return p.join(i, [*same, inside]).select("p.*", *rest)


def within_buckets(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, width: int, slack: int = 0) -> DataFrame:
    """As `within`, for keys with very many intervals: both sides also meet by time buckets of `width`, each interval
    in the buckets that it touches, so that a hot key spreads over tasks."""
    p = points.withColumn("__bucket", F.floor(F.col(at) / width))
    touched = F.sequence(F.floor((F.col(start) - slack) / width), F.floor((F.col(end) + slack) / width))
    i = intervals.withColumn("__bucket", F.explode(touched))
    return within(p, i, [*on, "__bucket"], at, start, end, slack).drop("__bucket")


#: Levels of dyadic nodes above the grain: enough for any pair of 64-bit times.
LEVELS = 62


def dyadic_nodes(start: Column, end: Column) -> Column:
    """The nodes (level, node) whose spans [node << level, (node + 1) << level) together are exactly start to end, ends in: at most two a level.

    At each level what is left begins at the next whole node and ends with the last; an odd begin and an odd end are nodes of their own."""
    up = lambda x, k: -F.call_function("shiftright", -x, k)  # noqa: E731  rounded up
    down = lambda x, k: F.call_function("shiftright", x, k)
    odd = lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1
    node = lambda level, x: F.struct(level.cast("int").alias("level"), x.alias("node"))

    def at(k: Column) -> Column:
        a, b = up(start.cast("long"), k), down(end.cast("long") + 1, k)
        return F.array(F.when((a < b) & odd(a), node(k, a)), F.when((a < b) & odd(b), node(k, b - 1)))

    # No level above the length holds a node.
    top = F.least(F.lit(LEVELS), F.ceil(F.log2((end - start + 2).cast("double"))).cast("int"))
    levels = F.when(start <= end, F.sequence(F.lit(0), top)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.flatten(F.transform(levels, at)), lambda n: n.isNotNull())


def within_dyadic(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, slack: int = 0, grain: int = 10) -> DataFrame:
    """As `within`, for intervals of any length and keys of any size: an interval goes to the dyadic nodes of time that it is made of, at most two for
    each doubling of its length, and a point to its node at each level that some interval uses. They meet on key, level and node, a pair at most once,
    so a hot key spreads over tasks. Times are whole numbers; nodes have at least 2^grain of them, and what rounding adds is filtered out."""
    named = intervals.withColumns({"__from": F.col(start) - slack, "__to": F.col(end) + slack})
    coarse = lambda c: F.call_function("shiftright", F.col(c).cast("long"), F.lit(grain))
    i = named.withColumn("__n", F.explode(dyadic_nodes(coarse("__from"), coarse("__to")))).select(*intervals.columns, F.col("__n.level").alias("__level"), F.col("__n.node").alias("__node"))
    used = sorted(r[0] for r in i.select("__level").distinct().collect())  # at most LEVELS
    if not used:
        return within(points, intervals, on, at, start, end, slack).limit(0)
    levels = F.explode(F.array(*[F.lit(x) for x in used]))
    p = points.withColumn("__level", levels).withColumn("__node", F.call_function("shiftright", F.col(at).cast("long"), F.col("__level") + grain))
    return within(p, i, [*on, "__level", "__node"], at, start, end, slack).drop("__level", "__node")


#: About how many points and ends of intervals one block of `counted_within` holds.
BLOCK = 1 << 17
POINT, CROSSING, STARTS, ENDS = range(4)


def _under(value: np.ndarray, first: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """For each `first` and `bound`, how many of the first so many values are under it: a prefix is a chunk for each bit of its length, chunks of one size are sorted at once."""
    ranks, n = np.unique(value, return_inverse=True), len(value)
    rank, bound = ranks[1], np.searchsorted(ranks[0], bound)
    out = np.zeros(len(first), np.int64)
    for k in range(n.bit_length()):
        asked = np.flatnonzero(first >> k & 1)
        if len(asked):
            chunks = np.sort(rank[: n >> k << k].reshape(-1, 1 << k), axis=1) + np.arange(n >> k)[:, None] * (n + 1)
            chunk = (first[asked] >> k) - 1
            out[asked] += np.searchsorted(chunks.ravel(), chunk * (n + 1) + bound[asked]) - (chunk << k)
    return out


def _counted(on: list[str]):
    """The parts of the counts of `counted_within` that rows of whole blocks tell."""

    def run(rows: pa.Table) -> pa.Table:
        group = np.zeros(rows.num_rows, np.int64)
        for c in [*on, "block"]:
            group = group * rows.num_rows + rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy()
            group = np.unique(group, return_inverse=True)[1]
        kind, x, y, id_ = (rows.column(c).to_numpy() for c in ("kind", "x", "y", "id"))

        def upto(points: np.ndarray, asks: np.ndarray, before: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Points in order of block and x; for each ask how many of them come before its block's first, and before it."""
            order = points[np.lexsort((x[points], group[points]))]
            every = np.concatenate([points, asks])
            is_ask = np.repeat([0, 1], [len(points), len(asks)])
            place = np.lexsort((1 - is_ask if before else is_ask, x[every], group[every]))
            passed = np.empty(len(every), np.int64)
            passed[place] = np.cumsum(1 - is_ask[place])
            return order, np.searchsorted(group[order], group[asks]), passed[len(points) :]

        def dominated(order: np.ndarray, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
            return _under(y[order], hi, bound) - _under(y[order], lo, bound)

        points, crossing, starts, ends = (np.flatnonzero(kind == k) for k in (POINT, CROSSING, STARTS, ENDS))
        order, lo, hi = upto(points, ends, False)
        n, members = hi - lo, dominated(order, lo, hi, y[ends])
        order, lo, hi = upto(points, starts, True)
        apart = y[starts] > rows.column("block").to_numpy()[starts]  # the interval ends in a later block, y
        whole = np.searchsorted(group[order], group[starts], "right")
        own = np.where(apart, dominated(order, lo, whole, x[starts]), 0) - (hi - lo)
        before = lo - hi
        order, lo, hi = upto(crossing, starts, True)
        own += dominated(order, lo, hi, y[starts])
        return pa.table({"id": id_[np.concatenate([ends, starts])], "n": np.concatenate([n, before]), "members": np.concatenate([members, own])})

    return run


def counted_within(points: DataFrame, intervals: DataFrame, on: list[str], at: str, member: str, start: str, end: str, slack: int = 0, block: int = BLOCK) -> DataFrame:
    """intervals with n and members: how many points of the same keys lie in each, widened by `slack` at both ends, and how many different members these have (null is none).
    Intervals without a point, or with null keys or ends, are left out. Times are whole numbers.

    No pair of a point and an interval is made, so work follows points plus intervals however many lie in each. A member counts at its first point in an interval, the
    one whose point before lies before the start. Times of a key are cut in blocks of about `block` points and ends; what lies in whole blocks is told by counts for pairs of
    blocks (the square of a key's blocks), the rest inside the blocks of both ends. Points of one key and time can't be parted."""
    spark, both = points.sparkSession, [*on, "x"]
    whole = intervals.withColumns({"__from": F.col(start).cast("long") - slack, "__to": F.col(end).cast("long") + slack}).where("__from <= __to").dropna(subset=on)
    asked = ranges.written(whole.withColumn("__id", F.monotonically_increasing_id()), "intervals")
    told = points.select(*on, F.col(at).cast("long").alias("t"), F.col(member).alias("member")).dropna(subset=[*on, "t"])
    before = F.when(F.col("member").isNull(), F.col("t")).otherwise(F.lag("t").over(Window.partitionBy(*on, "member").orderBy("t")))
    times = told.select(*on, F.col("t").alias("x")).unionByName(asked.select(*on, F.explode(F.array("__from", "__to")).alias("x")))
    sizes = ranges.written(times.groupBy(*on).agg(F.count("*").alias("size")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    # Only keys with more than a block have cuts: as many as they have blocks, of the shares of which every size takes its part.
    shares = min(total // block, 10_000)
    if shares > 1:
        large = times.join(F.broadcast(sizes.where(F.col("size") > block)), on)
        cut = large.groupBy(*on, "size").agg(F.percentile_approx("x", [i / shares for i in range(1, shares)], 10_000).alias("all"))
        step = F.greatest(F.lit(1), F.floor(F.lit(shares) * block / F.col("size")).cast("int"))
        cuts = cut.select(*on, F.array_sort(F.array_distinct(F.filter("all", lambda c, i: (i + 1) % step == 0))).alias("cuts"))
    else:
        cuts = sizes.limit(0).select(*on, F.array(F.lit(0).cast("long")).alias("cuts"))
    cuts = F.broadcast(ranges.written(cuts, "cuts"))

    def block_of(x: str) -> Column:
        """How many cuts are at x or before, by halving."""
        halves = F.array(*[F.lit(1 << k) for k in range(max(1, shares).bit_length(), -1, -1)])
        return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get("cuts", at + half - 1) <= F.col(x), at + half).otherwise(at))

    dealt = told.withColumn("before", before).join(cuts, on, "left").withColumns({"b": block_of("t"), "p": F.when(F.col("before").isNull(), -1).otherwise(block_of("before"))}).drop("cuts", "member")
    dealt = ranges.written(dealt, "points")
    placed = asked.select(*on, "__id", "__from", "__to").join(cuts, on, "left").withColumns({"i": block_of("__from"), "j": block_of("__to")}).drop("cuts")
    placed = ranges.written(placed, "placed")

    def row(kind: int, at: str, x: str, y: str, id_: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(at).alias("block"), F.col(x).alias("x"), F.coalesce(F.col(y).cast("long"), F.lit(-(1 << 63))).alias("y"), id_.alias("id"))

    none = F.lit(0).cast("long")
    mine = dealt.select(*on, F.explode(F.filter(F.array(row(POINT, "b", "t", "before", none), F.when((F.col("p") >= 0) & (F.col("p") < F.col("b")), row(CROSSING, "p", "before", "b", none))), lambda r: r.isNotNull())).alias("r"))
    theirs = placed.select(*on, F.explode(F.array(row(STARTS, "i", "__from", "j", F.col("__id")), row(ENDS, "j", "__to", "__from", F.col("__id")))).alias("r"))
    cells = mine.union(theirs).select(*on, "r.*").join(cuts.select(*on, F.lit(True).alias("large")), on, "left")
    bucket = F.when(F.col("large"), F.xxhash64(*on, "block")).otherwise(F.pmod(F.xxhash64(*on), F.lit(total // block + 1)))
    parts = cells.withColumn("bucket", bucket).drop("large").groupBy("bucket").applyInArrow(_counted(on), "id long, n long, members long").groupBy(F.col("id").alias("__id")).agg(F.sum("n").alias("n"), F.sum("members").alias("members"))

    # Whole blocks. upto: points of the key before the block; first: of those whose point before lies before block i, the ones in blocks after i up to b.
    counted = ranges.written(dealt.join(cuts.select(*on), on, "left_semi").groupBy(*on, "p", "b").agg(F.count("*").alias("c")), "cells")
    last = cuts.select(*on, F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("b"))
    running = lambda by, order: Window.partitionBy(*on, by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = last.join(counted.groupBy(*on, "b").agg(F.sum("c").alias("c")), [*on, "b"], "left").select(*on, "b", F.coalesce(F.sum("c").over(Window.partitionBy(*on).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("upto"))
    grid = last.where("b > 0").select(*on, "b", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("i"), F.lit(0).cast("long").alias("c"))
    grid = grid.unionByName(counted.where("p + 1 < b").select(*on, "b", (F.col("p") + 1).alias("i"), "c")).groupBy(*on, "b", "i").agg(F.sum("c").alias("c"))
    grid = grid.withColumn("h", F.sum("c").over(running("b", "i"))).select(*on, "i", (F.col("b") + 1).alias("j"), F.sum("h").over(running("i", "b")).alias("first"))
    found = placed.join(grid, [*on, "i", "j"], "left")
    for name in ("i", "j"):
        found = found.join(upto.select(*on, F.col("b").alias(name), F.col("upto").alias(f"upto_{name}")), [*on, name], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    found = found.join(parts, "__id").select("__id", (F.col("n") + zero("upto_j") - zero("upto_i")).alias("n"), (F.col("members") + zero("first")).alias("members"))
    return asked.join(found.where("n > 0"), "__id").select(*intervals.columns, "n", "members")


def as_of_sorted(facts: DataFrame, versions: DataFrame, key: tuple[str, str], at: str, valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "inner", parts: int | None = None) -> DataFrame:
    """As `as_of`, for members with very many versions and facts: both are put in one order by member and time, and the last version that began is carried
    forward, so no fact meets another version and no member has to fit in one task. key: the member's column in facts and in versions.

    A member's versions must not overlap (`quality.bad_history` tells); of versions that begin together the one that sorts last by content counts.
    Columns of facts come first; those of versions that facts have too are left out."""
    mine, theirs = key
    kept = [c for c in versions.columns if c not in facts.columns]
    fact, version = F.struct(*[F.col(f"`{c}`") for c in facts.columns]), F.struct(*[F.col(f"`{c}`") for c in kept], F.col(valid_to).alias("__until"))
    begun = versions.where(F.col(theirs).isNotNull() & F.col(valid_from).isNotNull()).select(F.col(theirs).alias("__k"), F.col(valid_from).alias("__t"), F.lit(0).alias("__kind"), version.alias("__version"))
    asked = facts.select(F.col(mine).alias("__k"), F.col(at).alias("__t"), F.lit(1).alias("__kind"), fact.alias("__fact"))
    # A version that begins at a fact's time is in force: versions sort before facts.
    both = begun.unionByName(asked, allowMissingColumns=True)
    found = ranges.deal(both, ["__k"], "__t", "__kind", parts=parts).scan(__last=ranges.known(F.col("__version"))).rows().where("__kind = 1")
    until = F.col("__last.__until")
    holds = F.col("__k").isNotNull() & F.col("__t").isNotNull() & F.col("__last").isNotNull() & (until.isNull() | (F.col("__t") < until))
    if how == "inner":
        found = found.where(holds)
    return found.select("__fact.*", *[F.when(holds, F.col("__last")[c]).alias(c) for c in kept])


def not_in(rows: DataFrame, members: DataFrame, column: str, member: str) -> DataFrame:
    """SQL's NOT IN: rows whose value is no member; rows with null are left out."""
    return rows.where(F.col(column).isNotNull()).join(members.where(F.col(member).isNotNull()).select(F.col(member).alias("__m")), F.col(column) == F.col("__m"), "left_anti")
