"""Column expressions shared by the plans. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Token in a user agent and the family it stands for, the most specific first.
BROWSER_TOKENS = (("Edg/", "Edge"), ("OPR/", "Opera"), ("Firefox/", "Firefox"), ("Chrome/", "Chrome"), ("Safari/", "Safari"))
FAMILIES = tuple(family for _, family in BROWSER_TOKENS) + ("Other",)
#: An origin in free text, the scrub's output and the mask.
ORIGIN = r"""https?://[^/\s"')]+"""
LOCALHOST, MASK = "http://localhost", "http://masked.invalid"


def instant(ms: Column | str) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def origin_of(href: Column) -> Column:
    """Scheme and host of an address, '' where there is none."""
    return F.coalesce(F.regexp_extract(href, r"^(https?://[^/]+)", 1), F.lit(""))


def seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def first_by(value: Column, order: Column) -> Column:
    """Aggregate: the non-null value of least order."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def last_by(value: Column, order: Column) -> Column:
    """Aggregate: the non-null value of greatest order."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, null where bottom is 0."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def browser_family(agent: Column) -> Column:
    """A user agent as its browser's name; a name stays as it is, null stays null."""
    out = F.when(agent.isNull(), F.lit(None).cast("string")).when(agent.isin(*FAMILIES), agent)
    for token, family in BROWSER_TOKENS:
        out = out.when(agent.contains(token), F.lit(family))
    return out.otherwise(F.lit("Other"))


def scrub_origins(text: Column) -> Column:
    """Every origin becomes localhost."""
    return F.regexp_replace(text, ORIGIN, LOCALHOST)


def mask_origins(text: Column, allowed: Iterable[str]) -> Column:
    """Origins of `allowed` stay, all others become the mask; a look-alike that only begins like one doesn't stay."""
    names = "|".join(re.escape(x) for x in sorted(allowed))
    keep = rf"""(?!(?:{names})(?![^/\s"')]))""" if names else ""
    return F.regexp_replace(text, keep + ORIGIN, MASK)


def map_strings(column: Column, kind: T.DataType, change: Callable[[Column], Column]) -> Column:
    """`change` applied to every string in a column at any depth, but for map keys."""
    if isinstance(kind, T.StringType):
        return change(column)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: map_strings(x, kind.elementType, change))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: map_strings(v, kind.valueType, change))
    if isinstance(kind, T.StructType):
        fields = [map_strings(column[f.name], f.dataType, change).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def hex_id(*parts: Column, size: int) -> Column:
    """The first `size` bytes, in hex, of the SHA-256 of the parts joined by the unit separator; null counts as 'None'."""
    texts = [F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    return F.substring(F.sha2(F.concat_ws("\x1f", *texts), 256), 1, 2 * size)


def nanos(ms: Column) -> Column:
    """Epoch milliseconds as a decimal string of nanoseconds, in whole numbers throughout."""
    return (ms.cast("long") * F.lit(1_000_000)).cast("string")


VALUE = "struct<stringValue:string,boolValue:boolean,intValue:string,doubleValue:double>"


def attributes(**pairs: tuple[Column, str]) -> Column:
    """A typed key-value list without the null ones; pairs: name (with __ for .) -> (column, string, bool, int or double)."""
    rows = []
    for name, (column, kind) in pairs.items():
        none = {"string": "string", "bool": "boolean", "int": "string", "double": "double"}
        typed = [(column.cast(none[k]) if k == kind else F.lit(None).cast(none[k])).alias(f"{k}Value") for k in ("string", "bool", "int", "double")]
        rows.append(F.when(column.isNotNull(), F.struct(F.lit(name.replace("__", ".")).alias("key"), F.struct(*typed).alias("value"))))
    return F.filter(F.array(*rows), lambda x: x.isNotNull())
