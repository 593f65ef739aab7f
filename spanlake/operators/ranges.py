"""Sequences too long for one task: rows dealt by ranges of (key, order), and scans that carry a small state from range to range.

A window by a session puts a whole session in one task. Here rows are dealt once, by ranges that may cut a key's rows anywhere, and
written, so that every later step sees the same ranges. A scan then has three parts: the state of each range's last key, one row a
range; a fold of these rows, which gives each range what its first key has had before; and windows inside the ranges, to which
that is added. Only the fold sees all ranges, and it sees a row for each.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE, TIE = "__range", "__tie"
TEXT_CHARS = 64
_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset one of our own, if all runs on this machine, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="spanlake-"))
    return _OWN[0]


def written(rows: DataFrame, name: str, *by: str) -> DataFrame:
    """The rows as a table in the shared folder, in a directory for each value of `by`; lineage ends here."""
    path = f"{shared_dir(rows.sparkSession)}/spanlake/{name}-{uuid.uuid4().hex}"
    (rows.write.partitionBy(*by) if by else rows.write).option("compression", "zstd").parquet(path)
    out = rows.sparkSession.read.schema(rows.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(rows: DataFrame) -> None:
    """Delete the table that written() made of these rows, once nothing reads it any more."""
    spark, path = rows.sparkSession, getattr(rows, "scratch_path", None)
    if path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Running:
    """What a scan computes of `value`; see total, most, known and before."""

    kind: str
    value: Column
    inclusive: bool = True


def total(value: Column, inclusive: bool = True) -> Running:
    """The sum of the key's rows up to this one, or up to the one before; nulls count nothing."""
    return Running("total", value, inclusive)


def most(value: Column, inclusive: bool = True) -> Running:
    """The largest value of the key's rows up to this one, or up to the one before; null if there is none."""
    return Running("most", value, inclusive)


def known(value: Column) -> Running:
    """The last value that isn't null, of the key's rows up to this one."""
    return Running("known", value)


def before(value: Column) -> Running:
    """The value of the key's row before this one, null too."""
    return Running("before", value)


def _sort(order: tuple[str, bool]) -> Column:
    name, down = order
    return F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_last()


@dataclass(frozen=True)
class Dealt:
    """Rows with the number of their range. Ranges ascend by key, then by order (names, with True for descending), nulls of the order last."""

    frame: DataFrame
    by: list[str]
    order: list[tuple[str, bool]]

    @property
    def _key(self) -> Column:
        return F.struct(*[F.col(c) for c in self.by]) if self.by else F.struct(F.lit(0).alias("all"))

    @property
    def _window(self):
        return Window.partitionBy(RANGE, *self.by).orderBy(*[_sort(o) for o in self.order], TIE)

    def _place(self) -> Column:
        """A value that ascends with the order."""
        if any(down for _, down in self.order):
            raise ValueError("known and before need an ascending order")
        return F.struct(*[x for c, _ in self.order for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(c))], TIE)

    def with_columns(self, **columns: Column) -> Dealt:
        return replace(self, frame=self.frame.withColumns(columns))

    def rows(self) -> DataFrame:
        return self.frame.drop(RANGE, TIE)

    def _state(self, r: Running) -> Column:
        if r.kind == "total":
            return F.sum(r.value)
        if r.kind == "most":
            return F.max(r.value)
        wanted = r.value.isNotNull() if r.kind == "known" else F.lit(True)
        return F.max_by(F.struct(r.value.alias("v")), F.when(wanted, self._place()))

    def carried(self, **running: Running) -> DataFrame:
        """For each range but the first what its first key has had in the ranges before: at most a row a range."""
        states = self.frame.groupBy(RANGE, *self.by).agg(*[self._state(r).alias(n) for n, r in running.items()])
        last = states.groupBy(RANGE).agg(F.max(self._key).alias("__key"), F.max_by(F.struct(*running), self._key).alias("__state"))
        so_far = Window.partitionBy("__key").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fold = {"total": F.sum, "most": F.max, "known": lambda c: F.last(c, ignorenulls=True), "before": F.last}
        folded = [fold[r.kind](F.col(f"__state.{n}")).over(so_far).alias(f"__c_{n}") for n, r in running.items()]
        return last.select(F.lead(RANGE).over(Window.orderBy(RANGE)).alias(RANGE), "__key", *folded).where(F.col(RANGE).isNotNull())

    def scan(self, **running: Running) -> Dealt:
        """The rows with a column for each running value. Values may read columns of earlier scans."""
        carry = F.broadcast(self.carried(**running)).alias("c")  # a row a range
        same = (F.col(f"f.{RANGE}") == F.col(f"c.{RANGE}")) & self._key.eqNullSafe(F.col("c.__key"))
        held = self.frame.alias("f").join(carry, same, "left").select("f.*", *[f"c.__c_{n}" for n in running])
        here, out = self._window, {}
        for n, r in running.items():
            run = here.rowsBetween(Window.unboundedPreceding, Window.currentRow if r.inclusive else -1)
            c = F.col(f"__c_{n}")
            if r.kind == "total":
                out[n] = F.coalesce(F.sum(r.value).over(run), F.lit(0)) + F.coalesce(c, F.lit(0))
            elif r.kind == "most":
                out[n] = F.greatest(F.max(r.value).over(run), c)
            elif r.kind == "known":
                out[n] = F.coalesce(F.last(F.when(r.value.isNotNull(), F.struct(r.value.alias("v"))), ignorenulls=True).over(run), c)["v"]
            else:
                out[n] = F.coalesce(F.lag(F.struct(r.value.alias("v"))).over(here), c)["v"]
        return replace(self, frame=held.withColumns(out).drop(*[f"__c_{n}" for n in running]))


def deal(rows: DataFrame, by: list[str], *order: str | tuple[str, bool], parts: int | None = None) -> Dealt:
    """Rows dealt by ranges and written. Rows that tie in key and order are put in an order by their content, so every run agrees; only
    equal rows can't be parted (with a text in the order, rows alike up to its first TEXT_CHARS characters). Without `parts` Spark chooses as many ranges as the data asks for."""
    told = [(o, False) if isinstance(o, str) else o for o in order]
    plain = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    tied = rows.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    sort, kinds = [F.col(c).asc() for c in by], dict(rows.dtypes)
    for name, down in told:
        if kinds[name] == "string":  # Spark gathers a sample of what it ranges by, so texts count with their beginnings and end the list
            begin = F.substring(name, 1, TEXT_CHARS)
            sort.append(begin.desc_nulls_last() if down else begin.asc_nulls_last())
            break
        sort.append(_sort((name, down)))
    else:
        sort.append(F.col(TIE))
    ranged = tied.repartitionByRange(*([parts] if parts else []), *sort).withColumn(RANGE, F.spark_partition_id())
    return Dealt(written(ranged, "dealt", RANGE), list(by), told)


# sequencing, as in `windows`, for keys of any size


def running_count(rows: DataFrame, flag: Column, by: list[str], *order: str, out: str, parts: int | None = None) -> DataFrame:
    """How many of the key's rows up to this one have the flag."""
    return deal(rows, by, *order, parts=parts).scan(**{out: total(F.when(flag, 1).otherwise(0))}).rows().withColumn(out, F.col(out).cast("int"))


def rank_by_first_seen(rows: DataFrame, by: list[str], member: str, order: str, out: str, parts: int | None = None) -> DataFrame:
    """The key's members numbered by when they were first seen; members first seen together share a number. Members are counted once each,
    and their rows get the number by a join, which Spark splits where a member has very many."""
    first = rows.groupBy(*by, member).agg(F.min(order).alias("__first"))
    ranked = deal(first, by, "__first", parts=parts).scan(__was=before(F.struct("__first")))
    new = F.when(F.col("__was").isNull() | ~F.col("__was.__first").eqNullSafe(F.col("__first")), 1).otherwise(0)
    numbers = ranked.scan(**{out: total(new)}).rows().select(*by, member, F.col(out).cast("int").alias(out))
    r, n = rows.alias("r"), numbers.alias("n")
    return r.join(n, [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*by, member]]).select("r.*", f"n.{out}")


def gaps(rows: DataFrame, by: list[str], order: str, more_than: int, carry: list[str] = (), parts: int | None = None) -> DataFrame:
    """Rows that come more than `more_than` after the key's row before, with prev_<order> and prev_<carry>."""
    lagged = deal(rows, by, order, parts=parts).scan(**{f"prev_{c}": before(F.col(c)) for c in [order, *carry]}).rows()
    return lagged.where(F.col(order) - F.col(f"prev_{order}") > more_than)


def _numbered(opened: Dealt, opens: Column, out: str) -> DataFrame:
    numbered = opened.with_columns(__opens=F.when(opens, 1).otherwise(0)).scan(**{out: total(F.col("__opens"))})
    return numbered.rows().withColumn(out, F.col(out).cast("int")).drop("__opens", "__was")


def islands_by_flag(rows: DataFrame, flag: str, by: list[str], order: str, out: str, parts: int | None = None) -> DataFrame:
    """Rows with the flag, numbered by runs of it: a run begins where the key's row before lacks it."""
    dealt = deal(rows, by, order, parts=parts).scan(__was=before(F.col(flag)))
    return _numbered(dealt, F.col(flag) & ~F.coalesce("__was", F.lit(False)), out).where(F.col(flag))


def gap_groups(rows: DataFrame, by: list[str], order: str, gap: int, out: str, parts: int | None = None) -> DataFrame:
    """Rows numbered by groups: one opens where the key's row before is more than `gap` away."""
    dealt = deal(rows, by, order, parts=parts).scan(__was=before(F.col(order)))
    return _numbered(dealt, F.col("__was").isNull() | (F.col(order) - F.col("__was") > gap), out)


# order statistics


def exact_percentiles(rows: DataFrame, by: list[str], value: str, shares: list[float], parts: int | None = None) -> DataFrame:
    """by, samples, largest, and p0, p1, ... for each share: exact, interpolated between neighbours; nulls count nothing.

    Equal values are counted first, and their counts dealt by ranges. The sums of the ranges tell in which range a wanted place lies,
    and only there values are put in order: no buffer holds a group's values.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    dealt = deal(counts, by, "__v", parts=parts)
    sums = dealt.frame.groupBy(*by, RANGE).agg(F.sum("__n").alias("__in"), F.max("__v").alias("__most"))
    # A row for each key and range: as many as there are keys, and the ranges that a key has more.
    key = Window.partitionBy(*by)
    sums = sums.withColumns({"__all": F.sum("__in").over(key), "largest": F.max("__most").over(key), "__left": F.sum("__in").over(key.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__in")})
    h = lambda q: (F.col("__all") - 1) * F.lit(float(q))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"), (F.ceil if up else F.floor)(h(q)).cast("long").alias("place")) for i, q in enumerate(shares) for up in (False, True)])
    targets = sums.select(*by, RANGE, "__all", "largest", "__left", "__in", F.explode(wanted).alias("w")).where(F.col("w.place").between(F.col("__left"), F.col("__left") + F.col("__in") - 1))
    hit = targets.select(*[F.col(c).alias(f"__k_{c}") for c in by], F.col(RANGE).alias("__r"), "__all", "largest", "__left", "w.*")
    only = dealt.frame.join(hit.select("__r").distinct(), F.col(RANGE) == F.col("__r"), "left_semi")
    upto = F.sum("__n").over(Window.partitionBy(RANGE, *by).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = only.withColumn("__upto", upto)
    same = [F.col(RANGE) == F.col("__r"), *[F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by]]
    inside = F.col("place").between(F.col("__left") + F.col("__upto") - F.col("__n"), F.col("__left") + F.col("__upto") - 1)
    found = placed.join(hit, [*same, inside])
    each = found.groupBy(*by).agg(F.max("__all").alias("samples"), F.max("largest").alias("largest"), *[F.max(F.when((F.col("i") == i) & (F.col("up") == up), F.col("__v"))).alias(f"__{i}{int(up)}") for i in range(len(shares)) for up in (False, True)])
    part = lambda q: (F.col("samples") - 1) * F.lit(float(q)) - F.floor((F.col("samples") - 1) * F.lit(float(q)))
    return each.select(*by, "samples", "largest", *[(F.col(f"__{i}0") + (F.col(f"__{i}1") - F.col(f"__{i}0")) * part(q)).alias(f"p{i}") for i, q in enumerate(shares)])
