"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.scratch import discard, written


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component_id (the smallest id reachable) of every id that has a link.

    Each round hangs every id's larger neighbours on its smallest one (large star), then its smaller
    neighbours and itself (small star), until nothing changes; rounds grow with the logarithm of the size.
    The links of an id are never gathered: minima are pre-aggregated and links joined with them. Null ends and
    links of an id with itself say nothing; an empty table gives an empty one.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = written(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where((u != v) & u.isNotNull() & v.isNotNull()).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are written, so that the joins read two plain shuffles and Spark can split the links of a hub over tasks.
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(lower, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = written(small.where("u != v").distinct(), "edges")
        now = _print(after)
        for done in (large, least, lower, edges):
            discard(done)
        edges = after
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots.select(F.col("v").alias("id"), F.col("v").alias("component_id")))
