"""Published relations: Parquet folders, a relational copy, a catalog, and evidence that the three agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.operators.quality import digest
from spanlake.plans.lake import LAYERS
from spanlake.plans.sanitize import masked_at_boundary


def publish(relations: dict[str, DataFrame], folder: str) -> None:
    """A zstd Parquet folder for each relation, masked; Spark picks the number of files by size."""
    for name, rows in relations.items():
        masked_at_boundary(rows).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What the folder holds, by the folder itself and not by a list in code."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = sorted(x.getPath().getName() for x in found if x.isDirectory() and not x.getPath().getName().startswith(("_", ".")))
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, position, column_name, column_type, row_count of every published relation; temp views of their names
    are made on the way, so spark.sql can query them."""
    out = None
    for name, rows in published(spark, folder).items():
        rows.createOrReplaceTempView(name)
        columns = [F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type")) for i, f in enumerate(rows.schema.fields)]
        one = rows.agg(F.count("*").alias("row_count")).select(F.explode(F.array(*columns)).alias("c"), "row_count").select("c.*", "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def flat(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for targets without nested types."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return rows.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in rows.schema.fields])


def _read_back(spark: SparkSession, url: str, name: str, properties: dict[str, str], like: DataFrame, parts: int) -> DataFrame:
    """A table of the database, read in `parts` by ranges of its first whole-number column where it has one."""
    whole = [f.name for f in like.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType))]
    if whole and parts > 1:
        low, high = like.agg(F.min(f"`{whole[0]}`"), F.max(f"`{whole[0]}`")).first()
        if low is not None and high > low:
            return spark.read.jdbc(url, name, column=f'"{whole[0]}"', lowerBound=low, upperBound=high, numPartitions=parts, properties=properties)
    return spark.read.jdbc(url, name, properties=properties)


def _in_one_transaction(spark: SparkSession, url: str, properties: dict[str, str], names: list[str]) -> None:
    """Each staged table takes the place of the one of its name; all of them or none."""
    jvm = spark._jvm
    told = jvm.java.util.Properties()
    for k, v in properties.items():
        told.setProperty(k, v)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    link = jvm.java.sql.DriverManager.getConnection(url, told)
    derby = url.startswith("jdbc:derby")
    try:
        link.setAutoCommit(False)
        statement = link.createStatement()
        there = set()
        found = link.getMetaData().getTables(None, None, "%", None)
        while found.next():
            there.add(found.getString("TABLE_NAME").upper())
        for name in names:
            if name.upper() in there:
                statement.executeUpdate(f"DROP TABLE {name}")
            statement.executeUpdate(f"RENAME TABLE {name}{STAGED} TO {name}" if derby else f"ALTER TABLE {name}{STAGED} RENAME TO {name}")
        link.commit()
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()


STAGED = "__new"


def load(spark: SparkSession, folder: str, url: str, properties: dict[str, str], prefix: str = "", parts: int = 8) -> list[str]:
    """Copy every published relation to a database; executors write their partitions.

    Tables are written beside the old ones, read back in parallel and compared by content, and then all take their places in one transaction. Who reads
    the database sees the old tables or the new ones, and a load that fails leaves the old ones whole."""
    names = []
    for name, rows in published(spark, folder).items():
        staged, given = f"{prefix}{name}{STAGED}", flat(rows)
        given.write.jdbc(url, staged, mode="overwrite", properties=properties)
        back = _read_back(spark, url, staged, properties, given, parts)
        if digest(back.select(*[F.col(f"`{c}`") for c in given.columns])).first() != digest(given).first():
            raise RuntimeError(f"{staged} differs from what was published")
        names.append(name)
    _in_one_transaction(spark, url, properties, [prefix + n for n in names])
    return names


def evidence(spark: SparkSession, relations: dict[str, DataFrame], folder: str, url: str | None = None, properties: dict[str, str] | None = None, prefix: str = "") -> DataFrame:
    """Per relation: layer, rows in the warehouse, in Parquet and in the database, columns with types, a sample row, verdict.

    The verdict compares contents: of each sink the count of rows, the sum of their hashes and each column's nulls. One aggregation for each relation and
    sink, united; no rows but samples are gathered."""
    there, out = published(spark, folder), None
    for name, rows in relations.items():
        given = flat(there[name])
        sides = [digest(flat(masked_at_boundary(rows))), digest(given)]
        sides.append(digest(spark.read.jdbc(url, prefix + name, properties=properties).select(*[F.col(f"`{c}`") for c in given.columns])) if url else sides[1])
        a, b, c = (side.select(F.struct("*").alias(n)) for side, n in zip(sides, ("w", "p", "j")))
        sample = there[name].agg(F.max(F.to_json(F.struct(*[F.col(f"`{c}`") for c in there[name].columns]))).alias("sample"))
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in there[name].schema.fields)
        verdict = F.when((F.col("w") == F.col("p")) & (F.col("j") == F.col("p")), "match").otherwise("differ")
        jdbc_rows = F.col("j.rows") if url else F.lit(None).cast("long")
        one = a.crossJoin(b).crossJoin(c).crossJoin(sample).select(  # a row each
            F.lit(name).alias("relation"), F.lit(LAYERS.get(name, "gold")).alias("layer"), F.col("w.rows").alias("warehouse_rows"), F.col("p.rows").alias("parquet_rows"), jdbc_rows.alias("jdbc_rows"),
            F.lit(types).alias("column_types"), "sample", verdict.alias("verdict"), (F.col("w.rows") == 0).alias("is_empty"),
        )
        out = one if out is None else out.unionByName(one)
    return out
