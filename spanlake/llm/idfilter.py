"""A filter of fixed size for ids: rows of other ids mostly go before a join shuffles them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spanlake.llm.shingles import mixed

BITS, PART_BITS = 24, 18


def _places(ids: pa.Array, bits: int) -> np.ndarray:
    return (mixed(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _marked(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            at = _places(batch.column(0), bits)
            np.bitwise_or.at(held, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        parts = held.reshape(-1, 1 << PART_BITS - 3)
        for i in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1)], pa.binary())], ["part", "bits"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            new = np.frombuffer(zlib.decompress(bits), np.uint8)
            held[i] = held[i] | new if i in held else new
    for i, bits in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())], ["part", "bits"])


def id_filter(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """The filter of the one column of `ids`: 2 ** bits flags whatever their number, eight a byte. With more ids it lets more of the
    others through, and the join that follows stays right."""
    merged = ids.mapInArrow(_marked(bits), "part int, bits binary").repartition(16, "part").mapInArrow(_merged, "part int, bits binary")
    held = np.zeros((1 << bits - PART_BITS, 1 << PART_BITS - 3), np.uint8)
    for r in merged.collect():  # rows of 32 kB, 2 MB with BITS
        held[r["part"]] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return held.ravel()


def may_be_in(held: np.ndarray, column: pa.Array) -> np.ndarray:
    """Which ids of an Arrow column may be among those of the filter; none that is gets lost."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    at = _places(column.fill_null(0), len(held).bit_length() + 2)
    return (held[at >> 3] >> (at & 7) & 1).astype(bool) & known


def likely_in(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose long `column` may be among `ids`; none of those is lost, some others may stay."""
    held = rows.sparkSession.sparkContext.broadcast(id_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_be_in(held.value, batch.column(column))))

    return rows.mapInArrow(run, rows.schema)
