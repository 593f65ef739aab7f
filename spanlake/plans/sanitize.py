"""Jobs that mask what may not leave, and the gate that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions.expr import FAMILIES, ORIGIN, browser_family, map_strings, mask_origins, scrub_origins
from spanlake.sources.landing import MALFORMED

#: Shapes that may not be published.
FORBIDDEN = ((r"[A-Za-z]:\\", "Windows drive path"), (r"/Users/", "Unix home path"), (r"/home/", "Unix home path"))
ADDED = ("session_id", "session_date", MALFORMED)


def origins(table: DataFrame, publishable: bool = False) -> list[str]:
    """Listed origins, or only those that may be published: a declared table, small by its nature."""
    rows = table.where("may_publish") if publishable else table
    return sorted(r[0] for r in rows.select("origin").collect())


def rewritten(records: DataFrame, change, skip: tuple[str, ...] = ()) -> DataFrame:
    """`change` applied to every string at any depth; the user agent becomes its browser's name."""
    out = {f.name: map_strings(F.col(f"`{f.name}`"), f.dataType, change) for f in records.schema.fields if f.name not in (*ADDED, *skip)}
    if "ua" in out:
        out["ua"] = browser_family(F.col("ua"))
    return records.withColumns(out)


def scrubbed(records: DataFrame) -> DataFrame:
    """Every origin becomes localhost: the rule for what is kept for good."""
    return rewritten(records, scrub_origins)


def sanitized_live(records: DataFrame, listed: list[str], publishable: list[str]) -> DataFrame:
    """The page's own address keeps a listed origin, all other strings only one that may be published."""
    return rewritten(records, lambda c: mask_origins(c, publishable), ("href",)).withColumn("href", mask_origins(F.col("href"), listed))


def violations(lines: DataFrame, allowed: list[str], column: str = "value") -> DataFrame:
    """record, problem: what a line of JSON holds that it may not; each origin once. The hash of the line names it,
    as a split file has no line numbers."""
    line = F.col(column)
    shapes = [F.when(line.rlike(p), F.lit(label)) for p, label in FORBIDDEN]
    found = F.array_except(F.array_distinct(F.regexp_extract_all(line, F.lit(f"({ORIGIN})"), F.lit(1))), F.array(*[F.lit(x) for x in allowed]).cast("array<string>"))
    agent = F.get_json_object(line, "$.ua")
    trimmed = F.when(agent.isNotNull() & ~agent.isin(*FAMILIES), F.concat(F.lit("un-trimmed ua "), agent))
    problems = F.filter(F.concat(F.array_distinct(F.array(*shapes)), F.transform(found, lambda o: F.concat(F.lit("unlisted origin "), o)), F.array(trimmed)), lambda p: p.isNotNull())
    return lines.where(F.trim(line) != "").select(F.sha2(line, 256).alias("record"), F.explode(problems).alias("problem"))


def as_lines(records: DataFrame) -> DataFrame:
    names = [c for c in records.columns if c not in ADDED]
    return records.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])).alias("value"))


def sanitize_job(spark: SparkSession, records: DataFrame, target: str, allowed: list[str], listed: list[str] | None = None) -> int:
    """Write sanitized records as JSON lines, a folder a session, then check what was written. Raises where it is not clean or
    records are missing; returns how many there are. `listed` (live captures): origins that the page's address may keep."""
    done = scrubbed(records) if listed is None else sanitized_live(records, listed, allowed)
    names = [c for c in done.columns if c not in ADDED]
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])).alias("value")
    done.select("session_id", text).write.mode("overwrite").partitionBy("session_id").text(target)
    back = spark.read.text(target)
    n, m = records.count(), back.count()
    if n != m:
        raise ValueError(f"{n} records became {m}")
    bad = violations(back.select("value"), sorted({*allowed, *(listed or ())}))
    if first := bad.take(1):
        raise ValueError(f"not clean: {first[0]['problem']}")
    return n


def masked_at_boundary(rows: DataFrame) -> DataFrame:
    """What a published relation may show: no page address, and an origin only where it may be published."""
    out = rows.drop("href")
    if {"origin", "origin_may_publish"} <= set(out.columns):
        out = out.withColumn("origin", F.when(F.col("origin_may_publish"), F.col("origin")))
    return out
