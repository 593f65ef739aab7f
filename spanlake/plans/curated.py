"""Questions asked of the typed relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions.expr import first_by, instant, last_by, seconds
from spanlake.operators import ranges, windows
from spanlake.sources.contract import cap

LOAD = ["session_id", "page_load_seq"]
GAP_MS = 3_000


def session_summary(sessions: DataFrame, pulses: DataFrame) -> DataFrame:
    srv = F.col("srv")
    run = pulses.groupBy(*LOAD).agg(
        F.max("kills").alias("kills"), first_by(F.col("hp"), srv).alias("hp_first"), F.min("hp").alias("hp_min"), last_by(F.col("hp"), srv).alias("hp_last"),
        last_by(F.col("state"), srv).alias("final_state"), F.countDistinct("state").alias("states_visited"),
    )
    quiet = (F.col("errors") == 0) & (F.col("alarms") == 0)
    outcome = F.when(F.col("ended_cleanly") & quiet, "clean").when(F.col("ended_cleanly"), "clean bye, with incidents").otherwise("abnormal end, no bye")
    out = sessions.join(run, LOAD, "left").withColumns({"duration_s": F.round("duration_s", 1), "outcome": outcome})
    return out.select(*LOAD, "client_id", "has_native_client_id", "ua", "origin", "origin_kind", "origin_may_publish", "duration_s", "beats", "alarms", "errors", "kills", "hp_first", "hp_min", "hp_last", "final_state", "states_visited", "outcome")


def percentiles(rows: DataFrame, by: str, value: str, accuracy: int | None = None, digits: int = 3) -> DataFrame:
    """samples, p50, p95 and largest of value; exact and interpolated by selection from ranges, or approximate with `accuracy`. samples counts every row."""
    if accuracy is None:
        found = ranges.exact_percentiles(rows, [by], value, [0.5, 0.95])
        told = rows.groupBy(by).agg(F.count("*").alias("samples")).withColumnRenamed(by, "__by").join(found.drop("samples"), F.col("__by").eqNullSafe(F.col(by)), "left")
        return told.select(F.col("__by").alias(by), "samples", F.round("p0", digits).alias("p50"), F.round("p1", digits).alias("p95"), "largest")
    q = F.percentile_approx(value, [0.5, 0.95], accuracy)
    return rows.groupBy(by).agg(F.count("*").alias("samples"), q.alias("__q"), F.max(value).alias("largest")).select(by, "samples", F.round(F.col("__q")[0], digits).alias("p50"), F.round(F.col("__q")[1], digits).alias("p95"), "largest")


def frame_time_by_span(spans: DataFrame, accuracy: int | None = None) -> DataFrame:
    kept = spans.where("origin = 'beat_trace'")
    worst = kept.groupBy("span").agg(F.round(F.max("ms_max"), 3).alias("worst_single_frame_ms"))
    out = percentiles(kept, "span", "ms", accuracy).join(worst, "span")
    return out.select("span", "samples", F.col("p50").alias("p50_ms"), F.col("p95").alias("p95_ms"), F.round("largest", 3).alias("max_mean_ms"), "worst_single_frame_ms")


def alarms_by_class(alarms: DataFrame, blockers: DataFrame, pulses: DataFrame) -> DataFrame:
    key = [*LOAD, "srv"]
    joined = alarms.join(blockers.select(*key, "held_key_count"), key, "left").join(pulses.select(*key, "state"), key, "left")
    return joined.groupBy("class").agg(
        F.count("*").alias("n"), F.countDistinct(F.struct(*LOAD)).alias("page_loads"), F.max("held_key_count").alias("held_keys_seen"),
        F.array_sort(F.collect_set("state")).alias("states_when_raised"),
    )


def deviation(rows: DataFrame, by: list[str], value: Column, prefix: str) -> DataFrame:
    """records, min, mean, max and population deviation of a difference of clocks."""
    d = rows.withColumn("__d", value)
    return d.groupBy(*by).agg(F.count("*").alias("records"), F.min("__d").alias(f"{prefix}_min_ms"), F.round(F.avg("__d"), 2).alias(f"{prefix}_mean_ms"), F.max("__d").alias(f"{prefix}_max_ms"), F.round(F.stddev_pop("__d"), 3).alias(f"{prefix}_stddev_ms"))


def clock_skew(records: DataFrame, sessions: DataFrame) -> DataFrame:
    kinds = sessions.select(*LOAD, "origin_kind")
    joined = records.where("wall IS NOT NULL").select(*LOAD, "srv", "wall").join(kinds, LOAD, "left").withColumn("origin_kind", F.coalesce("origin_kind", F.lit("unlisted")))
    return deviation(joined, ["origin_kind"], F.col("srv") - F.col("wall"), "skew")


def srv_gaps(records: DataFrame, more_than: int = GAP_MS) -> DataFrame:
    """Arrivals of one file more than three beats apart."""
    found = ranges.gaps(records.select(*LOAD, "srv", "vis"), ["session_id"], "srv", more_than, carry=["vis"])
    return found.select(*LOAD, "prev_srv", "srv", seconds(F.col("srv") - F.col("prev_srv")).alias("gap_s"), "prev_vis", "vis")


def explanation(before: Column, after: Column, gap_s: Column, hidden: str = "hidden", low: float = 30, high: float = 70) -> Column:
    both, either = (before == hidden) & (after == hidden), (before == hidden) | (after == hidden)
    return F.when(both & gap_s.between(low, high), "hidden tab, browser limited the timer to once a minute").when(either, "tab hidden, machine likely asleep").otherwise("VISIBLE THROUGHOUT, not explained by throttling")


def gap_explained(gaps: DataFrame) -> DataFrame:
    told = gaps.withColumn("explanation", explanation(F.col("prev_vis"), F.col("vis"), F.col("gap_s")))
    return told.groupBy("explanation").agg(F.count("*").alias("gaps"), F.round(F.min("gap_s"), 1).alias("shortest_s"), F.round(F.max("gap_s"), 1).alias("longest_s"), F.round(F.sum("gap_s"), 1).alias("total_s"))


def id_gaps(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """Received and expected rows of sequences without holes, and how many numbers are missing."""
    each = rows.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct(number).alias("d"), (F.max(number) - F.min(number) + 1).alias("e"))
    return each.agg(F.sum("n").alias("events_received"), F.sum("e").alias("ids_expected"), (F.sum("e") - F.sum("d")).alias("events_lost_by_id_gap"))


def loss_accounting(events: DataFrame, beats: DataFrame) -> DataFrame:
    most = cap("events_per_beat")
    peak = beats.agg(F.max("event_count").cast("long").alias("peak_events_in_one_beat"))
    out = id_gaps(events, LOAD, "id").crossJoin(peak)  # a row each
    return out.withColumns({"cap_events_per_beat": F.lit(most).cast("long"), "peak_pct_of_cap": F.round(100.0 * F.col("peak_events_in_one_beat") / F.lit(float(most)), 1)})


def coverage(dimension: str, documented: DataFrame, member: str, seen: DataFrame, column: str) -> DataFrame:
    """documented, exercised and never_seen of one dimension; null values are nobody's."""
    docs = documented.select(F.col(member).alias("m")).distinct()
    used = seen.where(F.col(column).isNotNull()).select(F.col(column).alias("m")).distinct()
    missing = docs.join(used, "m", "left_anti").agg(F.array_sort(F.collect_list("m")).alias("l"))
    counts = docs.agg(F.count("*").alias("documented")).crossJoin(used.agg(F.count("*").alias("exercised"))).crossJoin(missing)  # a row each
    return counts.select(F.lit(dimension).alias("dimension"), "documented", "exercised", F.when(F.size("l") > 0, F.col("l")).alias("never_seen"))


def dimension_coverage(pulses: DataFrame, documented: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, table in documented.items():
        one = coverage(name, table, name, pulses, name)
        out = one if out is None else out.unionByName(one)
    return out


def error_report(errors: DataFrame) -> DataFrame:
    return errors.select(*LOAD, instant("srv").alias("arrived"), "msg", "top_frame", "top_location")


def session_context(summary: DataFrame, alarms: DataFrame, errors: DataFrame) -> DataFrame:
    a = alarms.groupBy(*LOAD).agg(F.array_sort(F.collect_set("class")).alias("alarm_classes"))
    e = errors.groupBy(*LOAD).agg(F.transform(F.array_sort(F.collect_list(F.struct("srv", "msg"))), lambda x: x["msg"]).alias("error_messages"))
    out = summary.join(a, LOAD, "left").join(e, LOAD, "left")
    return out.select("client_id", "duration_s", "outcome", "final_state", "kills", "hp_first", "hp_last", "alarms", "errors", "alarm_classes", "error_messages")


def since_previous(rows: DataFrame, by: list[str], order: str, *tie: str) -> Column:
    return F.round(seconds(F.col(order) - F.lag(order).over(windows.ordered(by, order, *tie))), 3)


def incident_timeline(records: DataFrame) -> DataFrame:
    kind = F.col("kind")
    rows = records.where(kind.isin("err", "alarm")).select(*LOAD, "srv", F.when(kind == "err", "error").otherwise("alarm").alias("event"), F.when(kind == "err", F.col("msg")).otherwise(F.concat(F.lit("class="), "class")).alias("detail"))
    gap = since_previous(rows, ["session_id"], "srv", "event", "detail")
    return rows.select(*LOAD, instant("srv").alias("occurred_at"), "event", "detail", gap.alias("s_since_previous"))


def warehouse_manifest(records: DataFrame, alarms: DataFrame, errors: DataFrame, gaps: DataFrame, frames: DataFrame) -> DataFrame:
    counted = lambda rows, name: rows.agg(F.count("*").cast("int").alias(name))
    whole = records.agg(F.count("*").alias("records"), F.countDistinct(F.struct(*LOAD)).alias("sessions"), F.min("srv").alias("first_srv"), F.max("srv").alias("last_srv"))
    sampled = frames.agg(F.count("*").cast("int").alias("frame_spans"), F.coalesce(F.sum("samples"), F.lit(0)).cast("int").alias("frame_samples"))
    total = alarms.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("int").alias("alarms"))
    return whole.crossJoin(total).crossJoin(counted(errors, "errors")).crossJoin(counted(gaps, "gaps")).crossJoin(sampled)  # a row each
