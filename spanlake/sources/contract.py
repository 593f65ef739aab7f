"""The data contract of the session logs: schema, enums, caps and units, as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the contract.
RECORD_KINDS = ("hello", "beat", "alarm", "err", "bye")
MODES = ("brawl", "waves", "siege")
ALARM_CLASSES = ("loop-dead", "logic-freeze", "no-frames")
TRACE_LEVELS = ("off", "time", "ops")
VISIBILITIES = ("visible", "hidden")
ORIGIN_KINDS = ("local", "private", "public", "masked", "unlisted")
SECTIONS = ("sim", "tiles", "fog", "bodies", "vignette", "hud")
REQUIRED_FIELDS = {
    "hello": ("wall", "href", "ua", "dpr"),
    "beat": ("wall", "perf", "raf", "vis", "pulse", "events"),
    "alarm": ("class", "wall", "perf", "pulse", "blockers", "trace", "events"),
    "err": ("wall", "msg", "stack", "events"),
    "bye": ("wall", "events"),
}
#: name, value, in force from, in force until (None: still).
CAPS = (
    ("events_per_beat", 400, "2026-08-31T05:47:22Z", None),
    ("events_per_bye", 100, "2026-08-31T05:47:22Z", None),
    ("trace_frames", 120, "2026-08-31T05:47:22Z", None),
    ("logger_ring_capacity", 500, "2026-08-31T05:47:22Z", None),
    ("sink_body_bytes", 1_000_000, "2026-08-31T05:47:22Z", None),
)
#: Units of top-level and pulse fields.
UNITS = {
    "srv": "epoch_ms", "wall": "epoch_ms", "perf": "page_ms", "raf": "count", "dpr": "ratio", "dropped": "count",
    "pulse.t": "sim_s", "pulse.lastTs": "page_ms", "pulse.held": "count", "pulse.hp": "count", "pulse.kills": "count",
    "pulse.crows": "count", "pulse.skels": "count", "pulse.soldiers": "count", "pulse.arrows": "count",
    "blockers.frozen": "sim_s", "blockers.dashing": "sim_s", "blockers.x": "px", "blockers.y": "px", "trace.frames": "count",
}

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "bool": T.BooleanType()}


def _struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


def _each(kind: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, kind)


_SECTION = _struct(**_each("double", "ms", "msMax", "fillRect", "drawImage", "fill", "stroke", "px"))
_PULSE = _struct(**_each("string", "state", "mode", "map", "char"), t="double", lastTs="long", live="bool", **_each("long", "held", "hp", "kills", "crows", "skels", "soldiers", "arrows"), boss="string")
_EVENT = _struct(id="long", level="string", timestamp="long", source="string", message="string", data=T.MapType(T.StringType(), T.StringType()), code="string")
_BLOCKERS = _struct(frozen="double", charging="bool", dashing="double", buried="bool", snipeKeyHeld="bool", snipeKeyName="string", heldKeys=T.ArrayType(T.StringType()), x="double", y="double", **_each("string", "state", "char", "map"))
_TRACE = _struct(level="string", frames="long", spans=_struct(**{s: _SECTION for s in SECTIONS}))
_WIRE = _struct(
    kind="string", srv="long", cid="string", wall="long", href="string", ua="string", dpr="double", perf="long", raf="long", vis="string", dropped="long",
    **_each("string", "class", "msg", "stack"), pulse=_PULSE, events=T.ArrayType(_EVENT), blockers=_BLOCKERS, trace=_TRACE,
)


def with_units(schema: T.StructType, prefix: str = "") -> T.StructType:
    """The schema with each field's unit in its metadata."""
    out = []
    for f in schema.fields:
        kind = with_units(f.dataType, f"{prefix}{f.name}.") if isinstance(f.dataType, T.StructType) else f.dataType
        unit = UNITS.get(prefix + f.name)
        out.append(T.StructField(f.name, kind, f.nullable, {"unit": unit} if unit else {}))
    return T.StructType(out)


WIRE = with_units(_WIRE)


def merged(contract: T.DataType, seen: T.DataType) -> T.DataType:
    """The contract's types with fields that only the data has added at the end, at any depth."""
    if isinstance(contract, T.StructType) and isinstance(seen, T.StructType):
        known = {f.name: f for f in contract.fields}
        found = {f.name: f for f in seen.fields}
        out = [T.StructField(f.name, merged(f.dataType, found[f.name].dataType) if f.name in found else f.dataType, True, f.metadata) for f in contract.fields]
        return T.StructType(out + [f for f in seen.fields if f.name not in known])
    if isinstance(contract, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(merged(contract.elementType, seen.elementType))
    return contract


def caps_table(spark: SparkSession, caps=CAPS) -> DataFrame:
    """cap_key, cap_value, valid_from, valid_to."""
    rows = spark.createDataFrame(list(caps), "cap_key string, cap_value long, f string, t string")
    return rows.select("cap_key", "cap_value", F.to_timestamp("f").alias("valid_from"), F.to_timestamp("t").alias("valid_to"))


def cap(name: str, caps=CAPS) -> int:
    """The value in force; raises where there is none or several, as a null cap would pass every check."""
    found = [value for key, value, _, until in caps if key == name and until is None]
    if len(found) != 1:
        raise LookupError(f"{len(found)} values in force for cap {name!r}")
    return found[0]


def enum_table(spark: SparkSession, **domains: tuple[str, ...]) -> DataFrame:
    """domain, member: declared members as rows, for drift checks against reference data."""
    return spark.createDataFrame([(d, m) for d, members in domains.items() for m in members], "domain string, member string")
