"""The live path with Structured Streaming.

Page-load numbers and the orphan flag stay batch work: a rank over the life of a file is not incremental. Streams key on the
client id that records carry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanlake.functions.expr import instant
from spanlake.plans.typed import broken, with_members
from spanlake.sources.contract import WIRE
from spanlake.sources.landing import MALFORMED, Reference, identified


def read_live(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """New session files as they come, under the fixed schema; lines that do not fit come with their text."""
    schema = T.StructType([*WIRE.fields, T.StructField(MALFORMED, T.StringType())])
    stream = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return identified(stream, F.col("_metadata.file_path"))


def land_live(records: DataFrame, target: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to the raw layer; the checkpoint is the high-water mark, so no record lands twice."""
    writer = records.writeStream.format("parquet").option("compression", "zstd").option("path", target).option("checkpointLocation", checkpoint).partitionBy("session_date", "session_id")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def split_live(records: DataFrame, reference: Reference, good: str, bad: str, checkpoint: str) -> StreamingQuery:
    """The rules that need only the record itself, on each micro-batch: records with a fault of their own as a whole go to
    `bad`, and so do reports on the others; the rest go to `good`. A batch written again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        alone = batch.withColumns({"precedes_first_hello": F.lit(False), "page_load_seq": F.lit(None).cast("int")})
        marked = with_members(alone, reference).withColumn("faults", broken(alone)).drop("__known").persist()
        try:
            whole = F.col("srv").isNull() | F.col(MALFORMED).isNotNull()
            marked.where(~whole).drop("faults", "precedes_first_hello", "page_load_seq", MALFORMED).write.mode("overwrite").parquet(f"{good}/batch={number}")
            marked.select("session_id", "srv", "kind", F.inline("faults")).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            marked.unpersist()

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_bursts(events: DataFrame, by: str, at: str, gap_ms: int, late: str = "1 minute") -> DataFrame:
    """Groups of events less than or just `gap_ms` apart, closed once the watermark has passed them. `at`: epoch milliseconds."""
    timed = events.withColumn("ts", instant(at)).withWatermark("ts", late)
    grouped = timed.groupBy(by, F.session_window("ts", f"{gap_ms} milliseconds")).agg(F.count("*").alias("n"), F.min(at).alias("started"), F.max(at).alias("ended"))
    return grouped.drop("session_window")


def live_counts(events: DataFrame, by: str, at: str, width: str, late: str = "1 minute") -> DataFrame:
    """Events by tumbling windows."""
    timed = events.withColumn("ts", instant(at)).withWatermark("ts", late)
    return timed.groupBy(by, F.window("ts", width)).agg(F.count("*").alias("n")).select(by, F.col("window.start").alias("started"), "n")
