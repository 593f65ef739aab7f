"""Relations as OTLP and CloudEvents JSON. Records are built row by row on the executors, then put in payloads of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions.expr import attributes, hex_id, nanos
from spanlake.operators import ranges

#: Fixed values of the formats.
SEVERITY = {"INFO": 9, "WARN": 13, "ERROR": 17}
SERVICE = "spanlake"
EVENT_PREFIX = "com.spanlake"
BATCH_BYTES = 5_000_000


def _log(rows: DataFrame, ms: Column, level: Column, body: Column, attrs: Column) -> DataFrame:
    number = F.when(level == "ERROR", SEVERITY["ERROR"]).when(level == "WARN", SEVERITY["WARN"]).otherwise(SEVERITY["INFO"])
    record = F.struct(nanos(ms).alias("timeUnixNano"), number.alias("severityNumber"), level.alias("severityText"), F.struct(body.alias("stringValue")).alias("body"), attrs.alias("attributes"))
    return rows.select(ms.alias("at_ms"), record.alias("record"))


def otlp_logs(error_report: DataFrame, incidents: DataFrame, quarantine: DataFrame) -> DataFrame:
    """at_ms, record of everything that went wrong; a quarantined record is a warning."""
    load = {"session__id": (F.col("session_id"), "string"), "page_load__seq": (F.col("page_load_seq"), "int")}
    errors = _log(error_report, F.unix_millis("arrived"), F.lit("ERROR"), F.col("msg"), attributes(**load, code__function=(F.col("top_frame"), "string"), code__location=(F.col("top_location"), "string")))
    level = F.when(F.col("event") == "error", "ERROR").otherwise("WARN")
    happened = _log(incidents, F.unix_millis("occurred_at"), level, F.col("detail"), attributes(**load, incident__kind=(F.col("event"), "string"), incident__s_since_previous=(F.col("s_since_previous"), "double")))
    bad = _log(quarantine, F.col("srv"), F.lit("WARN"), F.col("detail"), attributes(**load, record__kind=(F.col("kind"), "string"), quarantine__reason=(F.col("reason"), "string"), quarantine__relation=(F.col("relation"), "string")))
    return errors.unionByName(happened).unionByName(bad)


def otlp_spans(spans: DataFrame, key: tuple[str, ...] = ("session_id", "page_load_seq", "srv", "origin", "event_id"), section: str = "span", at: str = "srv") -> DataFrame:
    """at_ms, record: a root span for each trace summary and a child for each section. Ids come from the keys, so every run gives
    the same ones. Durations are mean frame times; the worst frame and the count ride along."""
    sized = spans.withColumn("trace_id", hex_id(*[F.col(c) for c in key], size=16))
    root_id = hex_id(F.col("trace_id"), F.lit("root"), size=8)
    end = lambda ms: (F.col(at).cast("long") * 1_000_000 + F.floor(ms * 1_000_000).cast("long")).cast("string")
    roots = sized.groupBy("trace_id", *key).agg(F.sum("ms").alias("ms"), F.count("*").alias("n"))
    root = F.struct(
        F.col("trace_id").alias("traceId"), root_id.alias("spanId"), F.lit(None).cast("string").alias("parentSpanId"), F.concat(F.lit("frame."), "origin").alias("name"), F.lit(1).alias("kind"),
        nanos(F.col(at)).alias("startTimeUnixNano"), end(F.col("ms")).alias("endTimeUnixNano"),
        attributes(session__id=(F.col("session_id"), "string"), page_load__seq=(F.col("page_load_seq"), "int"), trace__origin=(F.col("origin"), "string"), frame__sections=(F.col("n"), "int")).alias("attributes"),
    )
    child = F.struct(
        F.col("trace_id").alias("traceId"), hex_id(F.col("trace_id"), F.col(section), size=8).alias("spanId"), root_id.alias("parentSpanId"), F.concat(F.lit("frame."), F.col(section)).alias("name"), F.lit(1).alias("kind"),
        nanos(F.col(at)).alias("startTimeUnixNano"), end(F.col("ms")).alias("endTimeUnixNano"),
        attributes(frame__section=(F.col(section), "string"), frame__mean_ms=(F.col("ms"), "double"), frame__max_ms=(F.col("ms_max"), "double"), frame__count=(F.col("frames"), "int")).alias("attributes"),
    )
    return roots.select(F.col(at).alias("at_ms"), root.alias("record")).unionByName(sized.select(F.col(at).alias("at_ms"), child.alias("record")))


def span_collisions(records: DataFrame) -> DataFrame:
    """How many child spans have an id that another has."""
    ids = records.where("record.parentSpanId IS NOT NULL").select("record.spanId")
    return ids.agg((F.count("*") - F.countDistinct("spanId")).alias("collisions"))


def otlp_metrics(loss: DataFrame, reconciled: DataFrame, alarms: DataFrame, frames: DataFrame, at_ms: int) -> DataFrame:
    """at_ms, record: a gauge for each number; the time is given, so a run can be repeated."""
    none = F.array().cast("array<struct<key:string,value:struct<stringValue:string,boolValue:boolean,intValue:string,doubleValue:double>>>")

    def gauge(rows: DataFrame, name: str, unit: str, value: str, labels: Column = none) -> DataFrame:
        return rows.select(F.lit(f"{SERVICE}.{name}").alias("name"), F.lit(unit).alias("unit"), F.struct(F.col(value).cast("double").alias("asDouble"), F.lit(str(at_ms * 1_000_000)).alias("timeUnixNano"), labels.alias("attributes")).alias("point"))

    section = attributes(frame__section=(F.col("span"), "string"))
    parts = [
        gauge(loss, "events.received", "{event}", "events_received"), gauge(loss, "events.lost", "{event}", "events_lost_by_id_gap"), gauge(loss, "beat.peak_pct_of_cap", "%", "peak_pct_of_cap"),
        gauge(reconciled, "records.landed", "{record}", "landed_records"), gauge(reconciled, "records.quarantined", "{record}", "quarantined_records"),
        gauge(alarms, "alarms", "{alarm}", "n", attributes(alarm__class=(F.col("class"), "string"))), gauge(frames, "frame.p50", "ms", "p50_ms", section), gauge(frames, "frame.p95", "ms", "p95_ms", section),
    ]
    points = parts[0]
    for p in parts[1:]:
        points = points.unionByName(p)
    # The points of a gauge are its classes or sections, a few.
    grouped = points.groupBy("name", "unit").agg(F.array_sort(F.collect_list("point"), lambda a, b: F.when(F.to_json(a) < F.to_json(b), -1).otherwise(1)).alias("dataPoints"))
    return grouped.select(F.lit(at_ms).cast("long").alias("at_ms"), F.struct("name", "unit", F.struct("dataPoints").alias("gauge")).alias("record"))


def _event(rows: DataFrame, kind: str, key: list[Column], data: Column, time: Column | None = None, subject: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    envelope = F.struct(
        F.lit("1.0").alias("specversion"), F.lit(f"{EVENT_PREFIX}.{kind}").alias("type"), F.lit(f"/{SERVICE}").alias("source"), hex_id(F.lit(kind), *key, size=16).alias("id"),
        (F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX") if time is not None else none).alias("time"), F.lit("application/json").alias("datacontenttype"), (none if subject is None else subject).alias("subject"), data.alias("data"),
    )
    return rows.select((F.unix_millis(time) if time is not None else F.lit(None).cast("long")).alias("at_ms"), F.to_json(envelope).alias("json"))


def error_events(error_report: DataFrame) -> DataFrame:
    data = F.struct(F.col("msg").alias("message"), "top_frame", F.col("top_location").alias("location"))
    return _event(error_report, "client.error", [F.col("session_id"), F.col("page_load_seq"), F.col("msg")], data, F.col("arrived"), F.concat("session_id", F.lit("#"), "page_load_seq"))


def cloud_events(summary: DataFrame, error_report: DataFrame, alarms: DataFrame) -> DataFrame:
    """at_ms, json: CloudEvents 1.0; attributes that are not set are left out, never sent as null."""
    session = F.struct("duration_s", "outcome", "final_state", "kills", "hp_first", "hp_last", "alarms", "errors", "beats", "ua", "states_visited")
    done = _event(summary, "session.completed", [F.col("session_id"), F.col("page_load_seq")], session, subject=F.col("client_id"))
    error = error_events(error_report)
    alarm = _event(alarms, "alarm.summary", [F.col("class")], F.struct("class", F.col("n").alias("count"), "page_loads", F.coalesce("states_when_raised", F.array().cast("array<string>")).alias("states_when_raised")))
    return done.unionByName(error).unionByName(alarm)


def after(records: DataFrame, mark: int | None) -> DataFrame:
    """Records later than the last exported one; those without a time always go."""
    return records if mark is None else records.where(F.col("at_ms").isNull() | (F.col("at_ms") > mark))


def high_water(records: DataFrame) -> int | None:
    return records.agg(F.max("at_ms")).first()[0]


#: Bytes of a block in which batches are followed at once, as a multiple of a batch; a block has at most two starts for each.
BLOCK_BATCHES = 8


def _followed(room: int, width: int):
    """applyInArrow, for the records of a block and those at the begin of the next: from each record at which a batch of an earlier block can have
    ended (entry), the starts of batches in this block and where the first after it begins."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        block = key[0].as_py()
        at, size, own = (group.column(c).to_numpy() for c in ("at", "bytes", "own"))
        order = np.argsort(at)
        at, end, own = at[order], (at + size)[order], own[order]
        fits = np.searchsorted(end, at + room, side="right") - 1
        after = np.maximum(end[np.maximum(fits, 0)], end)  # a record over the limit stands alone
        mine = np.flatnonzero(own)
        entries = mine[(at[mine] < block * width + room) | (np.arange(len(mine)) == 0)]
        starts = [[x] for x in at[entries].tolist()]
        now = after[entries]
        going = np.flatnonzero((now < (block + 1) * width) & (now <= at[-1]))
        while len(going):
            for i in going.tolist():
                starts[i].append(int(now[i]))
            now[going] = after[np.searchsorted(at, now[going])]
            going = going[(now[going] < (block + 1) * width) & (now[going] <= at[-1])]
        return pa.table({"block": pa.array([block] * len(entries), pa.int64()), "entry": pa.array(at[entries]), "next": pa.array(now), "starts": pa.array(starts, pa.list_(pa.int64()))})

    return run


def _reached(steps: DataFrame) -> DataFrame:
    """The entries that the batches from the first record on come by, each with how many starts are before it. steps: entry, next, n. Steps double each
    round, so rounds grow with the logarithm of the number of blocks."""
    reached = ranges.written(steps.where("entry = 0").select("entry", F.lit(0).cast("long").alias("offset")), "reached")
    jump = steps.select("entry", "next", "n")
    while True:
        on = jump.select("entry", "next", F.col("n").alias("__n"))
        new = reached.join(on, "entry").select(F.col("next").alias("entry"), (F.col("offset") + F.col("__n")).alias("offset")).join(steps.select("entry"), "entry", "left_semi")
        new = ranges.written(new, "reached")
        if new.limit(1).count() == 0:
            return reached
        reached = ranges.written(reached.union(new), "reached")
        further = jump.select(F.col("entry").alias("next"), F.col("next").alias("__next"), F.col("n").alias("__n"))
        jump = ranges.written(jump.join(further, "next").select("entry", F.col("__next").alias("next"), (F.col("n") + F.col("__n")).alias("n")), "jump")


def batched(records: DataFrame, most: int = BATCH_BYTES, wrapper: int = 0, parts: int | None = None) -> DataFrame:
    """batch, at_ms, bytes, json: records in the order of time and content, each batch as long as fits (next fit). A batch's bytes are those of its
    records, one between two of them, and `wrapper`; none exceeds `most`, but for a single record that does by itself.

    Records are dealt by ranges, and the bytes before each are counted from range to range. Where a batch ends follows from these sums. Blocks of a few
    batches are followed apart, from every record where a batch can begin; their ends are then linked by doubling. A null record is left out."""
    room = most - wrapper + 1
    if room < 1:
        raise ValueError("the wrapper alone exceeds the limit")
    width = BLOCK_BATCHES * room
    text = records.select("at_ms", (F.col("json") if "json" in records.columns else F.to_json("record")).alias("json")).where("json IS NOT NULL")
    sized = text.withColumn("bytes", F.octet_length("json").cast("long") + 1)
    dealt = ranges.deal(sized, [], "at_ms", "json", parts=parts)
    summed = dealt.scan(at=ranges.total(F.col("bytes"), inclusive=False)).rows()
    placed = ranges.written(summed.withColumn("block", F.floor(F.col("at") / width)), "placed")
    ranges.discard(dealt.frame)  # all that follows reads the placed records
    narrow = placed.select("block", "at", "bytes", F.lit(True).alias("own"))
    heads = narrow.where((F.col("at") - F.col("block") * width <= room) & (F.col("block") > 0)).select((F.col("block") - 1).alias("block"), "at", "bytes", F.lit(False).alias("own"))
    both = narrow.union(heads.join(narrow.select("block").distinct(), "block", "left_semi"))
    steps = ranges.written(both.groupBy("block").applyInArrow(_followed(room, width), "block long, entry long, next long, starts array<long>").withColumn("n", F.size("starts").cast("long")), "steps")
    true = ranges.written(steps.join(_reached(steps), "entry").select("block", "offset", "starts"), "true")
    # Only the last block can be without a start: all its records then are in the last batch.
    batches = true.agg(F.max(F.col("offset") + F.size("starts")).alias("batches"))
    told = placed.join(true, "block", "left").crossJoin(F.broadcast(batches))  # one row
    passed = F.size(F.filter("starts", lambda s: s <= F.col("at")))
    number = F.when(F.col("starts").isNull(), F.col("batches")).otherwise(F.col("offset") + passed) - 1
    return told.select(number.cast("long").alias("batch"), "at_ms", "bytes", "json")


#: signal -> what wraps its records in a payload.
WRAPPERS = {
    "logs": ('{{"resourceLogs":[{{"resource":{0},"scopeLogs":[{{"scope":{1},"logRecords":[', "]}]}]}"),
    "traces": ('{{"resourceSpans":[{{"resource":{0},"scopeSpans":[{{"scope":{1},"spans":[', "]}]}]}"),
    "metrics": ('{{"resourceMetrics":[{{"resource":{0},"scopeMetrics":[{{"scope":{1},"metrics":[', "]}]}]}"),
    "events": ("[", "]"),
}
MEDIA = {"logs": "application/json", "traces": "application/json", "metrics": "application/json", "events": "application/cloudevents-batch+json"}
PATHS = {"logs": "/v1/logs", "traces": "/v1/traces", "metrics": "/v1/metrics", "events": "/events"}


def payloads(records: DataFrame, signal: str, most: int = BATCH_BYTES) -> DataFrame:
    """signal, path, media_type, batch, records, payload: whole JSON bodies in the order of time, none larger than the limit but for a record that is by itself."""
    head, tail = WRAPPERS[signal]
    head = head.format(f'{{"attributes":[{{"key":"service.name","value":{{"stringValue":"{SERVICE}"}}}}]}}', f'{{"name":"{SERVICE}"}}') if signal != "events" else head
    rows = batched(records, most, len((head + tail).encode())).groupBy("batch").agg(F.count("*").alias("records"), F.array_sort(F.collect_list(F.struct(F.col("at_ms").isNull().alias("no_time"), "at_ms", "json"))).alias("held"))
    body = F.array_join(F.transform("held", lambda r: r["json"]), ",")
    return rows.select(F.lit(signal).alias("signal"), F.lit(PATHS[signal]).alias("path"), F.lit(MEDIA[signal]).alias("media_type"), "batch", "records", F.concat(F.lit(head), body, F.lit(tail)).alias("payload"))
