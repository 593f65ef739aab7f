"""Near duplicates among embeddings by cross-polytope hashing.

Each of several tables rotates a vector by random signs and fast Hadamard transforms, and hashes it to the
signed axis it lies nearest to, in as many rotations as a hash has digits. A row is stored under its own
hash and also looks under the next best ones (probes). Rows that meet are compared exactly.

A bucket with many rows is cut in blocks, and each pair of blocks is a group of its own: nothing is left out,
and no task gets the bucket. Links are counted where they are found; a pair counts only in the first place where
it meets, which both hash rows tell, so pairs are never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.components import components
from spanlake.llm.scratch import written
from spanlake.llm.vectors import cosines, element_type, from_bytes, norms, to_bytes, to_matrix, usable

BLOCK_ROWS = 1_024
GROUP_ROWS = 4_096
ROUNDS = 3


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, h = rows.shape[1], 1
    while h < n:
        pairs = rows.reshape(len(rows), n // (2 * h), 2, h)
        rows = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(rows), n)
        h *= 2
    return rows / np.sqrt(n)


def hashes(rows: np.ndarray, tables: int, digits: int, probes: int, seed: int) -> np.ndarray:
    """rows x tables x (1 + probes): each row's hash, then its next best ones."""
    width = 1 << max(1, int(rows.shape[1] - 1).bit_length())
    padded = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    rng = np.random.default_rng([seed, width])
    signs = rng.choice([-1.0, 1.0], (tables, digits, ROUNDS, width))
    out = np.zeros((len(rows), tables, 1 + probes), np.int64)
    for t in range(tables):
        axes, gaps = [], []
        for d in range(digits):
            turned = padded
            for r in range(ROUNDS):
                turned = hadamard(turned * signs[t, d, r])
            order = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, : probes + 1]
            value = np.take_along_axis(turned, order, 1)
            axes.append(2 * order + (value > 0))
            gaps.append(np.abs(value[:, :1]) - np.abs(value))
        base = 2 * width
        own = sum(axes[d][:, 0] * base ** (digits - 1 - d) for d in range(digits))
        other, cost = [], []
        for d in range(digits):
            for p in range(1, axes[d].shape[1]):
                other.append(own + (axes[d][:, p] - axes[d][:, 0]) * base ** (digits - 1 - d))
                cost.append(gaps[d][:, p])
        best = np.argsort(np.stack(cost, 1), axis=1, kind="stable")[:, :probes]
        out[:, t, 0], out[:, t, 1:] = own, np.take_along_axis(np.stack(other, 1), best, 1)
    return out


def _hashed(dtype: str, tables: int, digits: int, probes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            for width in np.unique(sizes):
                part = batch.filter(pa.array(sizes == width))
                raw = to_matrix(part.column("vector"), dtype)
                rows = raw.astype(np.float64)
                rows /= np.abs(rows).max(axis=1, keepdims=True)
                codes = hashes(rows / norms(rows)[:, None], tables, digits, probes, seed)
                flat = pa.array(codes.reshape(-1), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * tables * (1 + probes), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array([int(width)] * len(rows), pa.int32()), to_bytes(raw, dtype), lists], ["vec_id", "label", "width", "vector", "codes"])

    return run


def _least_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """pairs x tables: the least code, own or probe, that both rows have in a table; the largest number where there is none."""
    out = np.full(x.shape[:2], np.iinfo(np.int64).max)
    for p in range(x.shape[2]):
        shared = (x[:, :, p : p + 1] == y).any(axis=2)
        out = np.where(shared, np.minimum(out, x[:, :, p]), out)
    return out


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of n rows over the links (x, y)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        root = root[root]
        if (root == before).all():
            return root


def _linked(dtype: str, tables: int, probes: int, threshold: float):
    """One group: many small buckets of one table, or a pair of blocks of a full one."""

    def run(group: pa.Table) -> pa.Table:
        table, most = group.column("slot")[0].as_py(), np.iinfo(np.int64).max
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        label = group.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        key = [label, *(group.column(c).to_numpy() for c in ("code", "low", "high", "block"))]
        for width in np.unique(group.column("width").to_numpy()):
            at = np.flatnonzero(group.column("width").to_numpy() == width)
            at = at[np.lexsort([k[at] for k in reversed(key)])]
            part = group.take(pa.array(at))
            _, code, low, high, block = (k[at] for k in key)
            n, ids = len(at), part.column("vec_id").to_numpy()
            codes = part.column("codes").combine_chunks().flatten().to_numpy().reshape(n, tables, 1 + probes)
            rows = from_bytes(part.column("vector"), dtype)
            rows /= np.abs(rows).max(axis=1, keepdims=True)
            unit = rows / norms(rows)[:, None]
            same = np.all([k[at][1:] == k[at][:-1] for k in key[:4]], axis=0)
            bounds = [0, *(np.flatnonzero(~same) + 1).tolist(), n]
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in zip(bounds, bounds[1:]):
                alone = low[a] == high[a]
                middle = b if alone else a + int(np.searchsorted(block[a:b], high[a]))
                first = a if alone else middle
                for lo in range(a, middle, 512):
                    i, j = np.nonzero(unit[lo : min(lo + 512, middle)] @ unit[first:b].T >= threshold - 1e-9)
                    i, j = i + lo, j + first
                    keep = i < j if alone else ids[i] != ids[j]
                    if keep.any():
                        ends += [(i[keep][s : s + 50_000], j[keep][s : s + 50_000]) for s in range(0, int(keep.sum()), 50_000)]
            if not ends:
                continue
            links, kept = np.zeros(n, np.int64), []
            for x, y in _joined(ends, 50_000):
                ok = (ids[x] != ids[y]) & (cosines(rows[x], rows[y]) >= threshold)
                x, y = x[ok], y[ok]
                common = _least_common(codes[x], codes[y])
                here = (np.argmax(common < most, axis=1) == table) & (common[:, table] == code[x])
                x, y = x[here], y[here]
                links += np.bincount(x, minlength=n) + np.bincount(y, minlength=n)
                kept.append((x, y))
            hit = np.flatnonzero(links)
            root = _forest(n, *(np.concatenate(e) for e in zip(*kept)))
            out.append((ids[hit], links[hit], ids[root[hit]]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("vec_id", "links", "root"), columns)))

    return run


def _joined(ends: list[tuple[np.ndarray, np.ndarray]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of many small buckets together, about `most` at a time."""
    held, n = [], 0
    for e in ends:
        held.append(e)
        n += len(e[0])
        if n >= most:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, column: str = "embedding", tables: int = 8, digits: int = 2, probes: int = 3, block_rows: int = BLOCK_ROWS, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector.

    Two rows link when their labels are equal and not null, and their cosine in double precision is at least
    `threshold`; hashing may miss a link but makes none up. component_id is the smallest vec_id reachable; kept says
    that a row is its component's smallest. Rows without label, and vectors that are null, zero or hold null or
    non-finite components, are returned without links; vectors of different widths are not compared. Rows with
    the same vec_id are one vector each in their partners' counts but one row in the result; they do not link with each
    other. A null vec_id is kept and has no links. An empty table gives an empty result; other columns are ignored.
    """
    dtype = element_type(vectors, column)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col(column).alias("vector"))
    usual = every.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))).select("vec_id", F.col("label").cast("string").alias("label"), "vector")
    hashed = written(usual.mapInArrow(_hashed(dtype, tables, digits, probes, seed), "vec_id long, label string, width int, vector binary, codes array<long>"), "hashed")
    slot = (F.col("at") / (1 + probes)).cast("int")
    key = ["label", "width", "slot", "code"]
    seats = hashed.select("vec_id", "label", "width", F.posexplode("codes").alias("at", "code")).select("label", "width", slot.alias("slot"), "code")
    # Written, so that the join reads two plain shuffles and Spark can split a full bucket over tasks.
    counts = written(seats.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int")), "buckets")
    full = hashed.select("*", F.posexplode("codes").alias("at", "code")).withColumn("slot", slot)
    met = full.join(counts, key).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    spread = met.select(*key, "vec_id", "vector", "codes", "block", (F.col("blocks") > 1).alias("full"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = spread.select(*key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "vec_id", "vector", "codes", "block", "full")
    # Small buckets share groups of about GROUP_ROWS rows, as each group costs a call; each pair of blocks is its own.
    shards = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // (tables * GROUP_ROWS))
    small = F.pmod(F.xxhash64("label", "width", "code"), F.lit(shards))
    grouped = dealt.withColumn("group", F.when(F.col("full"), F.xxhash64("label", "width", "code", "low", "high")).otherwise(small))
    found = written(grouped.groupBy("slot", "group").applyInArrow(_linked(dtype, tables, probes, threshold), "vec_id long, links long, root long"), "links")
    counted = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    joined = components(found, "vec_id", "root").withColumnRenamed("id", "vec_id")
    ids = every.select("vec_id").distinct()
    out = ids.join(counted, "vec_id", "left").join(joined, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


#: All pairs of a label, and components by recursion: for small tables.
ORACLE = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
    SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT b.y, reach.r FROM reach JOIN ways b ON b.x = reach.vec_id
), roots AS (
    SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, (SELECT count(*) FROM ways WHERE ways.x = roots.vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM roots
"""
