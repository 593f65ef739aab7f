"""Approximate nearest neighbours with a forest of random-projection trees.

The trees are fitted on a bounded sample: every inner node splits its part of the sample at the median of
a projection on the difference of two of its points. All rows are then dealt to one leaf of each tree.
A query walks all trees through one priority queue, ordered by how far it lies on the wrong side of the
worst split on the way, and takes leaves until they hold the asked number of rows. Leaves and the queries
that chose them meet in a shuffle, where exact cosines are computed; the best of all leaves win.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.scratch import written
from spanlake.llm.vectors import cosines, element_type, from_bytes, norms, to_bytes, to_matrix, usable

SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 64 << 20
LEAF_ROWS = 800
#: Bounds the forest that is broadcast: leaves of larger tables hold more rows and are split over more tasks.
MOST_DEPTH = 10
CHUNK_ROWS = 8_192
TIE = 1e-9


@dataclass
class Forest:
    """Complete trees in heap order: children of node i are 2 i + 1 and 2 i + 2."""

    normals: np.ndarray  # trees, inner nodes, width
    cuts: np.ndarray  # trees, inner nodes
    depth: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """trees x rows: each row's leaf in each tree."""
        out = np.zeros((len(self.cuts), len(rows)), np.int32)
        for t, (normals, cuts) in enumerate(zip(self.normals, self.cuts)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + ((rows * normals[node]).sum(axis=1) >= cuts[node])
            out[t] = node - (self.leaves - 1)
        return out

    def search(self, query: np.ndarray, sizes: np.ndarray, budget: int) -> list[tuple[int, int]]:
        """(tree, leaf) pairs in order of promise until they hold `budget` rows. sizes: trees x leaves."""
        inner = self.leaves - 1
        margins = (self.normals @ query - self.cuts).tolist() if inner else []
        queue = [(0.0, t, 0) for t in range(len(self.cuts))]
        found, held = [], 0
        while queue and held < budget:
            cost, t, node = heapq.heappop(queue)
            if node >= inner:
                if n := int(sizes[t, node - inner]):
                    found.append((t, node - inner))
                    held += n
                continue
            side = margins[t][node]
            near, far = (2 * node + 2, 2 * node + 1) if side >= 0 else (2 * node + 1, 2 * node + 2)
            heapq.heappush(queue, (cost, t, near))
            heapq.heappush(queue, (max(cost, abs(side)), t, far))
        return found


def fit(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    """sample: unit vectors."""
    rng, inner = np.random.default_rng(seed), (1 << depth) - 1
    normals, cuts = np.zeros((trees, inner, sample.shape[1])), np.zeros((trees, inner))
    for t in range(trees):
        parts = [np.arange(len(sample))]
        for i in range(inner):
            part = parts[i]
            pick = rng.choice(part, 2, replace=False) if len(part) > 1 else []
            normal = sample[pick[0]] - sample[pick[1]] if len(pick) else np.zeros(sample.shape[1])
            if not normal.any():
                normal = rng.standard_normal(sample.shape[1])
            normals[t, i] = normal / np.sqrt((normal * normal).sum())
            side = sample[part] @ normals[t, i]
            cuts[t, i] = np.median(side) if len(part) else 0.0
            parts += [part[side < cuts[t, i]], part[side >= cuts[t, i]]]
    return Forest(normals, cuts, depth)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / norms(rows)[:, None]


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Large or tiny components must not overflow when squared; cosines do not change."""
    return rows / np.abs(rows).max(axis=1, keepdims=True)


def _dealt(forest, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = to_matrix(batch.column("vector"), dtype)
            leaves = forest.value.leaf_of(_unit(_scaled(raw.astype(np.float64))))
            packed = to_bytes(raw, dtype)
            for t, leaf in enumerate(leaves):
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.full(len(leaf), t), pa.int32()), pa.array(leaf, pa.int32()), packed], ["vec_id", "tree", "leaf", "vector"])

    return run


def _routed(forest, sizes, budget: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = to_matrix(batch.column("vector"), dtype)
            packed, unit = to_bytes(raw, dtype), _unit(_scaled(raw.astype(np.float64)))
            for i in range(batch.num_rows):
                chosen = forest.value.search(unit[i], sizes.value, budget)
                n = len(chosen)
                one = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(one), pa.array([t for t, _ in chosen], pa.int32()), pa.array([x for _, x in chosen], pa.int32()), packed.take(one)], ["vec_id", "tree", "leaf", "vector"])

    return run


def _nearest(k: int, dtype: str):
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return empty
        # Equal rows count once; an id that has several vectors is worth its best one.
        rows = rows.group_by(["vec_id", "vector"]).aggregate([])
        q, v = (_scaled(from_bytes(t.column("vector"), dtype)) for t in (queries, rows))
        q_id, v_id = queries.column("vec_id").to_numpy(), rows.column("vec_id").to_numpy()
        most = k * int(np.unique(v_id, return_counts=True)[1].max())
        out_q, out_v, out_s = [], [], []
        unit_v = _unit(v)
        for lo in range(0, len(q), 256):
            near = _unit(q[lo : lo + 256]) @ unit_v.T
            near[q_id[lo : lo + 256, None] == v_id[None, :]] = -np.inf
            kth = np.partition(near, -most, axis=1)[:, -most] if near.shape[1] > most else np.full(len(near), -2.0)
            i, j = np.nonzero(near >= np.maximum(kth, -2.0)[:, None] - TIE)
            exact = cosines(q[lo + i], v[j])
            order = np.lexsort((v_id[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            seen = i * len(v_id) + np.unique(v_id, return_inverse=True)[1][j]
            once = np.sort(np.unique(seen, return_index=True)[1])
            i, j, exact = i[once], j[once], exact[once]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            best = place < k
            out_q.append(q_id[lo + i[best]])
            out_v.append(v_id[j[best]])
            out_s.append(exact[best])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, column: str = "embedding", trees: int = 8, share: float = 1.5,
    sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` where is_query holds, the k rows of largest cosine found.

    A query's own vec_id is no candidate; ties go to the smaller vec_id; repeated vec_ids count once, with their best score, as queries
    and as candidates. Null vec_ids and vectors that are null, zero or hold null or non-finite components take no part; vectors
    are compared with those of their own width, each width having a forest of its own. `share`: the rows that a query
    inspects, counted once for each tree, as a share of all rows, at every size of the table. An empty table gives an
    empty result. Other columns are ignored.

    A forest is fitted on at most `sample_rows` rows (smallest hashes of vec_id), fewer where vectors are so wide that these would pass
    SAMPLE_BYTES, and has trees * 2 ** MOST_DEPTH leaves at most, so its broadcast is bounded; every row is in the index. Groups of a
    leaf's rows and queries are split beyond CHUNK_ROWS.
    """
    spark, dtype = vectors.sparkSession, element_type(vectors, column)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vector"), is_query.alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    widths = {r["width"]: r["count"] for r in every.groupBy(F.size("vector").alias("width")).count().collect()}  # as a rule one
    found = [_nearest_of_width(every.where(F.size("vector") == w), n, w, dtype, k, trees, share, sample_rows, leaf_rows, seed) for w, n in sorted(widths.items())]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    once = reduce(DataFrame.union, found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest_of_width(rows: DataFrame, total: int, width: int, dtype: str, k: int, trees: int, share: float, sample_rows: int, leaf_rows: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(sample_rows, SAMPLE_BYTES // (8 * width)))).select("vector")
    flat = np.concatenate([b.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False) for b in [sample.toArrow()]]).astype(np.float64)
    depth = min(MOST_DEPTH, max(0, int(np.log2(max(1, total / leaf_rows)))))
    model = fit(_unit(_scaled(flat.reshape(-1, width))), trees, depth, seed)
    forest = spark.sparkContext.broadcast(model)
    schema = "vec_id long, tree int, leaf int, vector binary"
    index = written(rows.select("vec_id", "vector").mapInArrow(_dealt(forest, dtype), schema), "forest")
    sizes = np.zeros((trees, model.leaves), np.int64)
    for r in index.groupBy("tree", "leaf").count().collect():  # at most trees * 2 ** depth rows
        sizes[r["tree"], r["leaf"]] = r["count"]
    budget = max(1, int(share * total))
    asked = written(rows.where(F.coalesce("asks", F.lit(False))).select("vec_id", "vector").mapInArrow(_routed(forest, spark.sparkContext.broadcast(sizes), budget, dtype), schema), "asked")
    chosen = {(r["tree"], r["leaf"]): r["count"] for r in asked.groupBy("tree", "leaf").count().collect()}
    cuts = [(t, x, max(1, -(-int(sizes[t, x]) // CHUNK_ROWS)), max(1, -(-chosen[t, x] // CHUNK_ROWS))) for t, x in chosen]
    parts = F.broadcast(spark.createDataFrame(cuts, "tree int, leaf int, row_parts int, query_parts int"))
    split = lambda own, other: (F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    r_own, r_all = split("row_parts", "query_parts")
    q_own, q_all = split("query_parts", "row_parts")
    keys = ["tree", "leaf", "row_part", "query_part"]
    left = asked.join(parts, ["tree", "leaf"]).select("tree", "leaf", q_all.alias("row_part"), q_own.alias("query_part"), "vec_id", "vector")
    right = index.join(parts, ["tree", "leaf"]).select("tree", "leaf", r_own.alias("row_part"), r_all.alias("query_part"), "vec_id", "vector")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_nearest(k, dtype), "query_id long, vec_id long, score double")
