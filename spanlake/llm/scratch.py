"""Tables written to the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset one of our own, if all runs on this machine (as in tests);
    executors elsewhere could not read it, so a cluster without the setting is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="spanlake-"))
    return _OWN[0]


ARROW_BATCH = 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Hold Arrow batches between the JVM and Python to 8 MB in this session, unless it has a lower limit. By default a batch
    has 10,000 rows whatever their size, which for long texts fills executors outside their heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > ARROW_BATCH:
        spark.conf.set(key, str(ARROW_BATCH))
    return spark


@contextmanager
def narrow_rows(spark: SparkSession) -> Iterator[None]:
    """Within it what is written has Arrow batches without a limit in bytes. To hold one Spark measures a batch after each row, which takes longer
    than to move a row of a few numbers; 10,000 of these are small anyway."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str((1 << 31) - 1))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/spanlake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows of df, written as Parquet in the shared folder and read again: lineage ends here,
    so a lost executor costs a read of these files and not the work before them. codec: how they are compressed, if not as the session says."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what written() made, once nothing reads it any more."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, *names: str) -> dict[str, str]:
    """For each name one that no column of df has, whatever the case, so that extra columns cannot clash."""
    taken, out = {c.lower() for c in df.columns}, {}
    for name in names:
        free = f"__{name}"
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out[name] = free
    return out
