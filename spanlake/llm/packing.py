"""Packing of tokenized documents into sequences of a fixed length, shortest pack first.

Documents are cut into pieces of at most `length` ids. Only the histogram of piece lengths (at most
`length` numbers) comes to the driver. There the lengths are placed longest first, each into the
shortest pack with room for it, as counts of packing patterns and never as single pieces. Every
piece then finds its pattern through its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.chunks import library_encoder, release, slices
from spanlake.llm.scratch import written

PART_ROWS = 100_000
#: Ids that a part holds at most (about), where pieces carry theirs.
PART_BYTES = 64 << 20
PIECE_SCHEMA = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, keep_space: bool, end: int | None, length: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path, keep_space)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = encoder(part.column("text"), end)
                total = np.diff(at)
                pieces = -(-total // length)
                doc = np.repeat(np.arange(len(total)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
                size = np.minimum(length, total[doc] - start)
                raw, first = ids.astype("<u4"), at[:-1][doc] + start
                bodies = [raw[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist())]
                crcs = [zlib.crc32(x) for x in bodies]
                columns = [part.column("doc_id").take(pa.array(doc)), part.column("row").take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crcs, pa.int64()), pa.array(total[doc], pa.int64())]
                names = ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array(bodies, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    return run


def pieces_of(docs: DataFrame, tokenizer: str, end: int | None = 1, length: int = 2048, keep_space: bool = False, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each document (null text: empty). `row` tells apart documents of the same id.
    Without `end` an empty document has no piece."""
    if length < 1:
        raise ValueError("length must be positive")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return slim.mapInArrow(_cut(tokenizer, keep_space, end, length, keep_ids), PIECE_SCHEMA + ", ids binary" * keep_ids)


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a pack) and how many packs have each.

    Lengths go longest first into the packs with most room; packs that are alike move together. A length
    of n pieces makes at most a few new kinds of packs, so the work follows the histogram and not the pieces.
    """
    room: dict[int, list[tuple[list[int], int]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left and room and (space := max(room)) >= size:
            # One piece for each of the emptiest packs; those that got one are looked at again with what room they have left.
            pattern, count = room[space].pop()
            if not room[space]:
                del room[space]
            if count > left:
                room[space].append((pattern, count - left))
            taken = min(count, left)
            room[space - size].append((pattern + [size], taken))
            left -= taken
        if left:
            fits = length // size  # a new pack is the emptiest until it has no room for one more
            full, rest = divmod(left, fits)
            if full:
                room[length - fits * size].append(([size] * fits, full))
            if rest:
                room[length - rest * size].append(([size] * rest, 1))
    return [kind for space in sorted(room) for kind in room[space]]


def slots(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, pieces of the length in a pack, first sequence, offset of the first) for
    each length of each pattern; the ranks of a length are shared out without gaps."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, count in patterns:
        offset, k = 0, 0
        while k < len(pattern):
            size = pattern[k]
            n = 1
            while k + n < len(pattern) and pattern[k + n] == size:
                n += 1
            out.append((size, used[size], used[size] + n * count - 1, n, sequence, offset))
            used[size] += n * count
            offset, k = offset + n * size, k + n
        sequence += count
    return out


SLOT = T.StructType([T.StructField(n, T.LongType(), False) for n in ("length", "first_rank", "last_rank", "repeat", "first_sequence", "first_offset")])


def pack_documents(docs: DataFrame, tokenizer: str, end: int | None = 1, length: int = 2048, keep_space: bool = False, keep_ids: bool = False, part_rows: int = PART_ROWS) -> DataFrame:
    """Each piece with its sequence_id and its offset there; sequences have no gaps before their padding.

    Null texts are empty; equal rows are packed one by one; empty tables give no rows; columns other than
    doc_id and text are not kept. A length that many pieces have is ranked in parts of about `part_rows`
    (with `keep_ids` of PART_BYTES at most, which makes more parts), and
    the parts' counts give each its first rank, so that no task holds all pieces of a length. Broadcast are a row
    for each part and the slots, a few for each length.
    """
    pieces = written(pieces_of(docs, tokenizer, end, length, keep_space, keep_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `length` rows
    spark = docs.sparkSession
    parts = F.broadcast(spark.createDataFrame([(size, max(-(-n // part_rows), -(-4 * n * size // PART_BYTES) * keep_ids)) for size, n in histogram.items()], "length long, parts long"))
    salted = pieces.join(parts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "row", "start"), F.col("parts")).cast("int")).drop("parts")
    counts = written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    table = spark.createDataFrame(slots(shortest_pack_first(histogram, length)), SLOT)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "row", "start")
    ranked = salted.withColumn("inside", F.row_number().over(inside) - 1).join(F.broadcast(bases), ["length", "salt"]).withColumn("rank", F.col("base") + F.col("inside"))
    # The slots of a length as one array: pieces of a common length look theirs up and are not joined with each.
    by_length = table.groupBy("length").agg(F.collect_list(F.struct("first_rank", "last_rank", "repeat", "first_sequence", "first_offset")).alias("slots"))
    found = ranked.join(F.broadcast(by_length), "length").select("*", F.expr("filter(slots, s -> rank BETWEEN s.first_rank AND s.last_rank)[0]").alias("slot"))
    step = F.col("rank") - F.col("slot.first_rank")
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot.first_sequence") + F.floor(step / F.col("slot.repeat"))).cast("long").alias("sequence_id"),
        (F.col("slot.first_offset") + F.pmod(step, F.col("slot.repeat")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def padding(packed: DataFrame, length: int = 2048) -> DataFrame:
    """sequences, tokens and the share of padded places; a sequence whose size is a power of two stays as it is."""
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    held = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, F.col("n")).otherwise(length)
    return sizes.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), (1 - F.sum("n") / F.sum(held)).alias("padding"))

