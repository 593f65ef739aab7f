"""Token ids in fixed-width bit packing.

A store is a Parquet folder with a row for each block. A block holds the ids of whole consecutive
documents, each id in `bits` bits (little end first), so id i of a block lies at bit i * bits and any
range unpacks with a few numpy operations. `docs` says where each document begins. Shards are ranges
of doc_id in ascending order, blocks are numbered within their shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.chunks import library_encoder, release, slices

BLOCK_IDS = 1 << 16
PACK_IDS = 1 << 16
BLOCK_SCHEMA = "shard int, block int, bits int, n_ids long, payload binary, docs array<struct<doc_id: long, at: long, n_tokens: long>>"
_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("bits", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary()),
     ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])))]
)


def bits_for(vocabulary: int) -> int:
    """The least width that holds every id below `vocabulary`."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    if len(ids) > PACK_IDS:  # whole bytes each, as PACK_IDS is a multiple of 8
        return b"".join(pack(ids[i : i + PACK_IDS], bits) for i in range(0, len(ids), PACK_IDS))
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes | memoryview, bits: int, first: int, count: int) -> np.ndarray:
    """Ids first .. first + count of a block, without touching the others."""
    begin = first * bits >> 3
    piece = bytes(payload[begin : (first + count) * bits + 7 >> 3])
    if bits in (8, 16, 32):
        return np.frombuffer(piece, f"<u{bits // 8}", count).astype(np.uint32)
    padded = np.frombuffer(piece + bytes(8), np.uint8)
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at = np.arange(count, dtype=np.int64) * bits + (first * bits & 7)
    return ((words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _blocks(path: str, keep_space: bool, end: int | None, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = library_encoder(path, keep_space), TaskContext.get().partitionId()
        bits = bits_for(encoder.vocabulary)
        number, held, docs, filled = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            payload = pack(np.concatenate(held), bits)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((shard, number, bits, filled, payload, docs), _ARROW.types)], schema=_ARROW)

        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = encoder(part.column("text"), end)
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    docs.append({"doc_id": doc_id, "at": filled, "n_tokens": b - a})
                    held.append(ids[a:b])
                    filled += b - a
                    if filled >= block_ids:
                        yield flush()
                        number, held, docs, filled = number + 1, [], [], 0
        if docs:
            yield flush()
        release()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int | None = 2, keep_space: bool = True, shards: int | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encode `text` of every document (null: empty) and write a store to `path`, in ascending doc_id order.

    Null doc_ids come first, and rows of one doc_id go by their text (null first); other columns are not kept; an empty
    table gives a store without blocks. A text stays whole in one block, so the largest block is `block_ids` ids and
    one document more. The raw texts are dealt by ranges of doc_id before they are encoded, so each is
    encoded once and nothing larger than text moves.
    """
    n = shards or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_blocks(tokenizer, keep_space, end, block_ids), BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """shard, start: ids in the shards before it. One row a shard, far fewer than blocks."""
    each = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def block_starts(blocks: DataFrame) -> DataFrame:
    """shard, block, block_start: ids of the whole store before the block."""
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inside"))
    return inside.join(shard_starts(blocks), "shard").select("shard", "block", (F.col("inside") + F.col("shard_start")).alias("block_start"))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read a store back: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    schema = "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("shard", "block", "bits", "payload", "docs")}
                payload, bits = memoryview(row["payload"].as_buffer()), row["bits"].as_py()
                docs = row["docs"].as_py()
                crcs = [zlib.crc32(unpack(payload, bits, d["at"], d["n_tokens"]).astype("<u4").tobytes()) for d in docs]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"].as_py()] * n, pa.int32()), pa.array([row["block"].as_py()] * n, pa.int32()), *(pa.array([d[k] for d in docs], pa.int64()) for k in ("doc_id", "at", "n_tokens")), pa.array(crcs, pa.int64())],
                    ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    blocks = read_blocks(spark, path)
    starts = block_starts(blocks.select("shard", "block", "n_ids"))
    rows = blocks.select("shard", "block", "bits", "payload", "docs").mapInArrow(run, schema)
    return rows.join(starts, ["shard", "block"]).select("doc_id", (F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_range(spark: SparkSession, path: str, doc_id: int, first: int, count: int) -> np.ndarray:
    """Random access: ids first .. first + count of one document (fewer where it ends), the first by text if several rows have
    its doc_id. KeyError if none has. Only the block with the document is unpacked, and of it only these ids."""
    blocks = read_blocks(spark, path)
    places = blocks.select("shard", "block", F.inline("docs")).where(F.col("doc_id") == doc_id)
    place = places.orderBy("shard", "block", "at").first()
    if place is None:
        raise KeyError(doc_id)
    row = blocks.where((F.col("shard") == place["shard"]) & (F.col("block") == place["block"])).select("bits", "payload").first()
    return unpack(row["payload"], row["bits"], place["at"] + first, max(0, min(count, place["n_tokens"] - first)))
