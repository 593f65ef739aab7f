"""From landed records to typed relations under the contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions.expr import origin_of, seconds
from spanlake.operators import ranges
from spanlake.sources.contract import ALARM_CLASSES, REQUIRED_FIELDS, SECTIONS, TRACE_LEVELS, VISIBILITIES, RECORD_KINDS, cap
from spanlake.sources.landing import MALFORMED, RECORD, Reference, current

RULE = "struct<relation:string,reason:string,detail:string>"
LOAD = ["session_id", "page_load_seq"]


def landed(raw: DataFrame) -> DataFrame:
    """Records with client_id, page_load_seq and the orphan flag, by scans over ranges: a session may be of any size.

    Records of one arrival time are ordered hello first, then by kind and content, so the count of hellos is
    the same in every run."""
    tied = raw.withColumns({"__first": F.when(F.col("kind") == "hello", 0).otherwise(1), "__row": F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns if c not in ("events", "pulse", "blockers", "trace", RECORD)])})
    counted = ranges.running_count(tied, F.col("kind") == "hello", ["session_id"], "srv", "__first", "kind", "__row", out="__hellos")
    client = F.coalesce(F.col("cid"), F.concat_ws("#", "session_id", F.col("__hellos").cast("string")))
    named = counted.withColumns({"client_id": client, "precedes_first_hello": F.col("__hellos") == 0, "has_native_client_id": F.col("cid").isNotNull()})
    return ranges.rank_by_first_seen(named, ["session_id"], "client_id", "srv", "page_load_seq").drop("__first", "__row", "__hellos")


def with_members(records: DataFrame, reference: Reference) -> DataFrame:
    """Records with `__known`, the declared members of each enumeration: one row, made in the same job and joined to all records."""
    tables = {"state": current(reference.states), "mode": reference.modes, "char": current(reference.characters), "boss": current(reference.bosses), "origin": reference.origins}
    every = reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("name"), F.col(n).alias("member")) for n, t in tables.items()])
    one = every.agg(F.struct(*[F.collect_set(F.when(F.col("name") == n, F.col("member"))).alias(n) for n in tables]).alias("__known"))
    return records.crossJoin(one)


def rule(broken: Column, relation: str, reason: str, detail: Column) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(relation).alias("relation"), F.lit(reason).alias("reason"), detail.alias("detail")))


def _told(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("<null>")))


def rules(records: DataFrame, strict: bool = False) -> list[Column]:
    """Each rule as a column of records that went through with_members: null where it holds. `strict` adds the declared rules that are opt-in."""
    kind, pulse = F.col("kind"), F.col("pulse")
    unknown = lambda name, value: ~F.array_contains(F.col("__known")[name], value)
    out = [rule(F.col("precedes_first_hello"), "landed", "orphan_record_no_hello", F.lit("record precedes the first hello in its session file"))]
    for name in ("state", "mode", "char", "boss"):
        out.append(rule(pulse.isNotNull() & unknown(name, pulse[name]), "pulses", f"{name}_not_in_contract", _told(name, pulse[name])))
    size = F.size("events")
    out += [
        rule((kind == "alarm") & ~F.col("class").isin(*ALARM_CLASSES), "alarms", "alarm_class_not_in_contract", _told("class", F.col("class"))),
        rule((kind == "beat") & (size > cap("events_per_beat")), "beats", "events_per_beat_over_cap", _told("events", size)),
        rule((kind == "bye") & (size > cap("events_per_bye")), "sessions", "events_per_bye_over_cap", _told("events", size)),
        rule(F.col("trace.frames") > cap("trace_frames"), "spans", "trace_frames_over_cap", _told("frames", F.col("trace.frames"))),
        rule((kind == "hello") & unknown("origin", origin_of(F.col("href"))), "sessions", "origin_not_in_reference", _told("origin", origin_of(F.col("href")))),
        rule(F.col("srv").isNull(), "landed", "srv_missing", F.lit("srv IS NULL")),
    ]
    if MALFORMED in records.columns:
        out.append(rule(F.col(MALFORMED).isNotNull(), "landed", "malformed_json", F.col(MALFORMED)))
    if strict:
        out.append(rule(~kind.isin(*RECORD_KINDS), "landed_fields", "kind_not_in_contract", _told("kind", kind)))
        out.append(rule((kind == "beat") & ~F.col("vis").isin(*VISIBILITIES), "beats", "visibility_not_in_contract", _told("vis", F.col("vis"))))
        out.append(rule(~F.col("trace.level").isin(*TRACE_LEVELS), "spans", "trace_level_not_in_contract", _told("level", F.col("trace.level"))))
        for k, fields in REQUIRED_FIELDS.items():
            for f in fields:
                out.append(rule((kind == k) & F.col(f).isNull(), "landed_fields", "required_field_missing", F.lit(f"{k}.{f}")))
    return out


def broken(records: DataFrame, strict: bool = False) -> Column:
    """The reports on a record."""
    return F.filter(F.array(*[r.cast(RULE) for r in rules(records, strict)]), lambda r: r.isNotNull())


def quarantine(records: DataFrame, reference: Reference, strict: bool = False) -> DataFrame:
    """A row for each rule that a record breaks, from one pass over the records."""
    kept = with_members(records, reference).select(*LOAD, "srv", "kind", F.explode(broken(records, strict)).alias("rule"))
    return kept.select("rule.relation", *LOAD, "srv", "kind", "rule.reason", "rule.detail")


def whole_record_fault(records: DataFrame) -> Column:
    bad = F.col("precedes_first_hello") | F.col("srv").isNull()
    return bad | F.col(MALFORMED).isNotNull() if MALFORMED in records.columns else bad


def clean(records: DataFrame) -> DataFrame:
    """Records without a fault of the record as a whole; other faults are reported and stay."""
    kept = records.where(~whole_record_fault(records))
    return kept.drop(MALFORMED) if MALFORMED in kept.columns else kept


def reconciliation(records: DataFrame, faults: DataFrame) -> DataFrame:
    """Landed = clean + quarantined records, in one aggregation; a record with two whole-record faults counts once."""
    bad = whole_record_fault(records)
    counts = records.agg(F.count("*").alias("landed_records"), F.count_if(~bad).alias("clean_records"), F.count_if(bad).alias("quarantined_records"))
    every = faults.agg(F.count("*").alias("quarantine_rows_all"), F.count_if(F.col("relation") == "landed").alias("__whole"))
    reported = (F.col("__whole") >= F.col("quarantined_records")) & (F.col("clean_records") + F.col("quarantined_records") == F.col("landed_records"))
    return counts.crossJoin(every).withColumn("reconciles", reported).drop("__whole")


def quarantine_summary(faults: DataFrame) -> DataFrame:
    return faults.groupBy("relation", "reason").agg(F.count("*").alias("n"))


def with_origin(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """origin_kind and origin_may_publish; an origin that no row names is unlisted and may not be published."""
    known = origins.select("origin", F.col("kind").alias("__kind"), F.col("may_publish").alias("__may"))
    joined = rows.join(known, "origin", "left")
    return joined.withColumns({"origin_kind": F.coalesce("__kind", F.lit("unlisted")), "origin_may_publish": F.coalesce("__may", F.lit(False))}).drop("__kind", "__may")


def sessions(records: DataFrame, reference: Reference) -> DataFrame:
    kind = F.col("kind")
    activity = records.groupBy(*LOAD).agg(
        F.min(F.when(kind == "bye", F.col("srv"))).alias("bye_srv"), F.max("srv").alias("last_srv"),
        F.count_if(kind == "beat").alias("beats"), F.count_if(kind == "alarm").alias("alarms"), F.count_if(kind == "err").alias("errors"),
    )
    hello = records.where(kind == "hello").select("session_id", "session_date", "page_load_seq", "client_id", "has_native_client_id", F.col("srv").alias("hello_srv"), F.col("wall").alias("hello_wall"), "href", origin_of(F.col("href")).alias("origin"), "ua", "dpr")
    out = with_origin(hello, reference.origins).join(activity, LOAD, "left")
    return out.withColumns({"ended_cleanly": F.col("bye_srv").isNotNull(), "duration_s": seconds(F.coalesce("bye_srv", "last_srv") - F.col("hello_srv"))})


def beats(records: DataFrame) -> DataFrame:
    return records.where("kind = 'beat'").select("session_id", "session_date", "page_load_seq", "client_id", "srv", "wall", "perf", "raf", "vis", F.size("events").alias("event_count"))


def pulses(records: DataFrame) -> DataFrame:
    names = ("state", "mode", "char", "map", "t", "lastTs", "live", "held", "hp", "kills", "crows", "skels", "soldiers", "arrows", "boss")
    return records.where("pulse IS NOT NULL").select(*LOAD, "client_id", "srv", "kind", *[F.col("pulse")[n].alias(n) for n in names])


def events(records: DataFrame) -> DataFrame:
    out = records.select(*LOAD, "client_id", F.col("srv").alias("drained_srv"), F.col("kind").alias("drained_by"), F.explode("events").alias("e"))
    return out.select(*LOAD, "client_id", "drained_srv", "drained_by", *[F.col("e")[n].alias(n) for n in ("id", "level", "timestamp", "source", "message", "code")])


def alarms(records: DataFrame) -> DataFrame:
    return records.where("kind = 'alarm'").select(*LOAD, "client_id", "srv", "wall", "perf", "class", F.col("trace.level").alias("trace_level"), F.col("trace.frames").alias("trace_frames"))


def blockers(records: DataFrame) -> DataFrame:
    b = F.col("blockers")
    return records.where(b.isNotNull()).select(*LOAD, "client_id", "srv", "class", *[b[n].alias(n) for n in ("frozen", "charging", "dashing", "buried", "snipeKeyHeld", "snipeKeyName")], F.size(b["heldKeys"]).alias("held_key_count"), b["x"].alias("x"), b["y"].alias("y"))


def errors(records: DataFrame) -> DataFrame:
    frame = F.regexp_extract("stack", r"at ([A-Za-z0-9_.$]+) \(", 1)
    place = F.regexp_extract("stack", r"([A-Za-z0-9_.-]+\.(?:ts|js):\d+:\d+)", 1)
    return records.where("kind = 'err'").select(*LOAD, "client_id", "srv", "wall", "msg", "stack", frame.alias("top_frame"), place.alias("top_location"))


#: A line of a trace summary: section, mean, worst, fills, images, megapixels.
TRACE_LINE = r"^(\w+)\s+([0-9.]+)ms\s+max\s+([0-9.]+)\s+(\d+) fill\s+(\d+) img\s+([0-9.]+)Mpx"


def unpivoted(rows: DataFrame, keep: list[str], members: dict[str, dict[str, Column]], name: str) -> DataFrame:
    """A row for each member with its values: fixed columns turned into rows."""
    parts = [F.struct(F.lit(m).alias(name), *[c.alias(k) for k, c in values.items()]) for m, values in members.items()]
    return rows.select(*keep, F.explode(F.array(*parts)).alias("__m")).select(*keep, "__m.*")


def alarm_spans(records: DataFrame) -> DataFrame:
    rows = records.where("trace IS NOT NULL").select(*LOAD, "client_id", "srv", F.lit("alarm_trace").alias("origin"), F.lit(None).cast("long").alias("event_id"), "trace")
    members = {s: {"ms": F.col("trace.spans")[s]["ms"], "ms_max": F.col("trace.spans")[s]["msMax"], "frames": F.col("trace.frames")} for s in SECTIONS}
    return unpivoted(rows, [*LOAD, "client_id", "srv", "origin", "event_id"], members, "span")


def trace_lines(records: DataFrame) -> DataFrame:
    """Each line of each trace summary that events carry, with the section it names ('' where it can't be parsed)."""
    e = records.select(*LOAD, "client_id", "srv", F.explode("events").alias("e")).where((F.col("e.source") == "trace") & F.col("e.data")["rows"].isNotNull())
    frames = F.expr("try_cast(regexp_extract(e.message, '^([0-9]+) frames', 1) AS bigint)")
    rows = e.select(*LOAD, "client_id", "srv", F.col("e.id").alias("event_id"), frames.alias("frames"), F.explode(F.from_json(F.col("e.data")["rows"], "array<string>")).alias("line"))
    return rows.withColumn("span", F.regexp_extract("line", TRACE_LINE, 1))


def beat_spans(records: DataFrame) -> DataFrame:
    value = lambda i: F.regexp_extract("line", TRACE_LINE, i).cast("double")
    return trace_lines(records).where("span <> ''").select(*LOAD, "client_id", "srv", F.lit("beat_trace").alias("origin"), "event_id", "span", value(2).alias("ms"), value(3).alias("ms_max"), "frames")


def unparsed_lines(records: DataFrame) -> DataFrame:
    return trace_lines(records).agg(F.count("*").alias("lines"), F.count_if(F.col("span") == "").alias("unparsed"))


def spans(records: DataFrame) -> DataFrame:
    return alarm_spans(records).unionByName(beat_spans(records))
