"""Reading session logs and reference files, and landing logs as partitioned Parquet."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions.expr import instant
from spanlake.sources.contract import WIRE, merged

SESSION_FILE = r"session-([0-9TZ:.-]+)\.jsonl$"
MALFORMED = "_corrupt_record"
UNKNOWN_SESSION = "unknown"
#: The column that holds a whole line.
RECORD = "record"


def session_id_of(path) -> F.Column:
    """The session in a file's name; 'unknown' where the name holds none (an empty partition value reads back as null)."""
    found = F.regexp_extract(path, SESSION_FILE, 1)
    return F.when(found != "", found).otherwise(UNKNOWN_SESSION)


def identified(records: DataFrame, path) -> DataFrame:
    return records.withColumns({"session_id": session_id_of(path), "session_date": F.to_date(instant("srv"))})


def read_lines(spark: SparkSession, path: str, schema: T.StructType = WIRE, mode: str = "PERMISSIVE", line_bytes: int | None = None, keep: bool = False) -> DataFrame:
    """JSON lines by one scan of their text: the schema's columns, _corrupt_record, and line_size, the bytes of the line as read.

    A line that is no JSON, holds a value of another type, or has more than `line_bytes` bytes comes with its text in _corrupt_record (mode FAILFAST
    raises for the first two). Blank lines are no records. With `keep` the whole line is also there as a VARIANT in `record`, so what the
    contract lacks is kept at any depth without a look at the data first; see `unknown_fields` and `with_unknown`."""
    fields = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("__path"), F.octet_length("value").alias("line_size"))
    parsed = lines.withColumn("__r", F.from_json("value", fields, {"mode": mode, "columnNameOfCorruptRecord": MALFORMED}))
    told = [F.col("__r")[f.name].alias(f.name, metadata=f.metadata) for f in schema.fields]
    long = F.col("line_size") > line_bytes if line_bytes else F.lit(False)
    record = [F.expr("try_parse_json(value)").alias(RECORD)] if keep else []
    records = parsed.select(*told, F.when(long, F.col("value")).otherwise(F.col("__r")[MALFORMED]).alias(MALFORMED), "line_size", *record, "__path")
    return identified(records, F.col("__path")).drop("__path")


def read_wire(spark: SparkSession, path: str, admit_unknown: bool = True, mode: str = "PERMISSIVE", line_bytes: int | None = None) -> DataFrame:
    """`read_lines` under the contract's schema and, with `admit_unknown`, the fields that the contract lacks with the types found in the data (which takes a
    scan of its own; `read_lines` with `keep` does without)."""
    schema = WIRE
    if admit_unknown:
        seen = spark.read.option("mode", "PERMISSIVE").json(path).schema
        seen = T.StructType([f for f in seen.fields if f.name != MALFORMED])
        schema = merged(WIRE, seen)
    return read_lines(spark, path, schema, mode, line_bytes).drop("line_size")


def _lacking(contract: T.DataType, seen: T.DataType) -> T.DataType | None:
    """What of `seen` the contract lacks, at any depth; None if nothing."""
    if isinstance(contract, T.StructType) and isinstance(seen, T.StructType):
        known = {f.name: f.dataType for f in contract.fields}
        new = {f.name: f.dataType if f.name not in known else _lacking(known[f.name], f.dataType) for f in seen.fields}
        fields = [T.StructField(name, kind) for name, kind in new.items() if kind is not None]
        return T.StructType(fields) if fields else None
    if isinstance(contract, T.ArrayType) and isinstance(seen, T.ArrayType):
        inner = _lacking(contract.elementType, seen.elementType)
        return T.ArrayType(inner) if inner is not None else None
    return None


def unknown_fields(records: DataFrame, contract: T.StructType = WIRE) -> T.StructType:
    """The fields in `record` that the contract lacks, at any depth, with their types (VARIANT where rows differ): one aggregation over landed rows."""
    told = records.agg(F.expr(f"schema_of_variant_agg({RECORD})")).first()[0]
    if told is None or not told.startswith("OBJECT<"):
        return T.StructType()
    seen = T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", told))
    return _lacking(contract, seen) or T.StructType()


def with_unknown(records: DataFrame, fields: T.StructType) -> DataFrame:
    """A column unknown_<name> for each top-level field of `fields`, read from `record`; null where a row lacks it or holds another type."""
    read = {f"unknown_{f.name}": F.try_variant_get(F.col(RECORD), f"$['{f.name}']", f.dataType.simpleString()) for f in fields.fields}
    return records.withColumns(read)


def land(records: DataFrame, path: str) -> None:
    """Write the raw layer by session_date and session_id, in order of arrival, overwriting only the partitions at hand.

    Rows are dealt by session, so each partition is few files; sessions of one date share a task only by hash."""
    dealt = records.repartition("session_date", "session_id").sortWithinPartitions("session_id", F.col("srv").asc_nulls_last())
    dealt.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("session_date", "session_id").parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw layer; partition values keep their types (a session id that looks like a number stays text)."""
    files = spark.read.option("recursiveFileLookup", "false")
    schema = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "session_id" else T.DateType() if f.name == "session_date" else f.dataType, True, f.metadata) for f in schema.fields]
    return files.schema(T.StructType(fields)).parquet(path)


def newest_session(records: DataFrame) -> DataFrame:
    """The rows of the last session by name (ISO names sort in time); raises for an empty source."""
    last = records.agg(F.max("session_id")).first()[0]
    if last is None:
        raise ValueError("no session to read")
    return records.where(F.col("session_id") == last)


@dataclass
class Reference:
    """Reference dimensions, each with a row for each version of a member."""

    states: DataFrame
    characters: DataFrame
    bosses: DataFrame
    modes: DataFrame
    origins: DataFrame


_VERSIONED = "note string, valid_from timestamp, valid_to timestamp"


def read_reference(spark: SparkSession, folder: str) -> Reference:
    read = lambda name, schema: spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}.csv")
    return Reference(
        read("app_states", f"state string, is_run_state boolean, in_run boolean, {_VERSIONED}"),
        read("characters", f"char string, {_VERSIONED}"),
        read("boss_kinds", f"boss string, {_VERSIONED}"),
        read("modes", "mode string, note string"),
        read("origins", "origin string, kind string, may_publish boolean, note string"),
    )


def current(versions: DataFrame) -> DataFrame:
    return versions.where("valid_to IS NULL").drop("valid_from", "valid_to")
