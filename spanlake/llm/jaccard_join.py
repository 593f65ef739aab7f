"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of word shingles, ordered rare first. Two sets that reach the threshold share a
shingle among the first n - o + 1 of each (o: the least overlap), and l shingles among the first
n - o + l. Each document takes the l that its postings make cheapest; a pair needs as many shared prefix
shingles as the smaller l of the two says. It is a candidate if the parities of its sets, a bit for each residue of a
hash, differ in no more bits than linked sets can differ in members; only then are whole sets compared.

The order comes from a sketch of fixed size that counts every shingle of the corpus, so shingles of common
passages stand last and are in few prefixes. Documents of equal sets are one from the start. Candidates make
a graph; its components are the groups in which whole sets are compared, block against block, so that each
set moves once (for a large group once a block) and no candidate pairs of a group of near copies are listed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.chunks import release, slices
from spanlake.llm.components import components
from spanlake.llm.idfilter import id_filter, may_be_in
from spanlake.llm.scratch import discard, written
from spanlake.llm.shingles import shingle_sets

SKETCH_BITS = 22
CHUNK_BITS = 16
LEVELS = 3
#: Shingles that more prefixes hold make groups, in which parities are compared; beyond CROWDED all documents of a shingle are one group.
COMMON, CROWDED = 32, 4096
#: Documents of a shingle whose parities are compared at once with those of another block.
PARITY_DOCS = 1024
#: The parity of a set has as many bits as the set members, up to the next power of two, in 1 to so many words of 64.
MOST_WORDS = 256
#: Flags of the filter of shared shingles, at least and at most: 2 to 16 MB.
FILTER_BITS = 24, 27
BLOCK_DOCS = 256
COLUMNS = 4_096


def _count(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                for tokens in shingle_sets(part.column("text"), k):
                    np.add.at(total, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
        parts = total.reshape(-1, 1 << CHUNK_BITS)
        used = np.flatnonzero(parts.any(axis=1))
        for c in used.tolist():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([zlib.compress(parts[c].tobytes(), 1)], pa.binary())], ["chunk", "counts"])
        release()

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            have = total.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint64))
            have += np.frombuffer(zlib.decompress(counts), np.uint32)
    for chunk, counts in total.items():
        rank = np.minimum(255, np.floor(4 * np.log2(counts.astype(np.float64) + 1))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(rank.tobytes(), 1)], pa.binary())], ["chunk", "counts"])


def frequency_ranks(docs: DataFrame, k: int) -> np.ndarray:
    """For each of 2 ** SKETCH_BITS parts of the hash range about 4 log2 of how often a shingle of any document falls there.
    Every document counts; the sketch (4 MB) does not grow with the corpus."""
    parts = docs.select("text").mapInArrow(_count(k), "chunk int, counts binary")
    added = parts.repartition(max(1, 1 << SKETCH_BITS - CHUNK_BITS - 2), "chunk").mapInArrow(_add, "chunk int, counts binary")
    out = np.zeros((1 << SKETCH_BITS - CHUNK_BITS, 1 << CHUNK_BITS), np.uint8)
    for r in added.collect():  # at most 64 rows of 64 kB
        out[r["chunk"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return out.ravel()


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parity(tokens: np.ndarray) -> bytes:
    """For each residue of the tokens whether their number is odd: sets that differ in d members differ in d bits at most."""
    words = min(MOST_WORDS, 1 << max(0, (max(1, len(tokens)) - 1).bit_length() - 6))
    odd = np.bincount((tokens & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bits: pa.Array, rows: np.ndarray, words: int) -> np.ndarray:
    """The parities of rows of one length, as for so many words."""
    out = np.frombuffer(b"".join(bits.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)
    while out.shape[1] > words:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def may_link(n: np.ndarray, m: np.ndarray, distance: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of n and m members, whose parities differ in so many bits, may reach the threshold."""
    total = n + m
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (distance <= total - 2 * -(-percent * total // (100 + percent)))


def _near(percent: int):
    """The pairs that may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            x, y = batch.column("x"), batch.column("y")
            v, w = (pc.binary_length(c).to_numpy() // 8 for c in (x, y))
            good = np.zeros(batch.num_rows, bool)
            for a, b in np.unique(np.stack([v, w]), axis=1).T.tolist():
                rows = np.flatnonzero((v == a) & (w == b))
                words = min(a, b)
                distance = np.bitwise_count(_folded(x, rows, words) ^ _folded(y, rows, words)).sum(axis=1, dtype=np.int64)
                good[rows] = may_link(n[rows], m[rows], distance, percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _near_in(percent: int):
    """Links of documents of one shingle, of one block or two, that may reach the threshold: as few as join what they join."""

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("rep").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        ids, n, block = (group.column(c).to_numpy() for c in ("rep", "n_shingles", "block"))
        bits = group.column("bits").combine_chunks()
        words = pc.binary_length(bits).to_numpy() // 8
        left, right = (np.flatnonzero(block == group.column(c)[0].as_py()) for c in ("low", "high"))
        x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in np.unique(words[left]).tolist():
            for b in np.unique(words[right]).tolist():
                own, other, least = left[words[left] == a], right[words[right] == b], min(a, b)
                theirs = _folded(bits, other, least)
                for part in np.array_split(own, len(own) * len(other) * least // (1 << 22) + 1):
                    if len(part):
                        distance = np.bitwise_count(_folded(bits, part, least)[:, None] ^ theirs).sum(axis=2, dtype=np.int64)
                        i, j = np.nonzero(may_link(n[part][:, None], n[other], distance, percent))
                        x.append(part[i])
                        y.append(other[j])
        root = forest(len(ids), np.concatenate(x), np.concatenate(y))
        hit = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[hit], "b": ids[root[hit]]})

    return run


def _posted(percent: int, held):
    """The shingles of prefixes that the filter lets through, each with the least l at which its document's prefix holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, n = batch.column("head"), batch.column("n_shingles").to_numpy()
            tokens, sizes = heads.flatten(), heads.value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            good = np.flatnonzero(may_be_in(held.value, tokens))
            row = row[good]
            level = np.maximum(1, at[good] - (n - -(-percent * n // 100))[row] + 1)
            yield pa.RecordBatch.from_arrays([batch.column("rep").take(pa.array(row)), pa.array(n[row]), tokens.take(pa.array(good)), pa.array(level, pa.int32())], ["rep", "n_shingles", "token", "level"])

    return run


def _prefixes(ranks, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, digests, heads, bits = [], [], [], []
                for tokens in shingle_sets(part.column("text"), k):
                    n = len(tokens)
                    order = np.lexsort((tokens, rank[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                    sizes.append(n)
                    digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    heads.append(tokens[order[: n - least_overlap(n, percent) + LEVELS]].view(np.int64) if n else [])
                    bits.append(parity(tokens))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(heads, pa.list_(pa.int64())), pa.array(bits, pa.binary())], ["doc_id", "n_shingles", "digest", "head", "bits"])
        release()

    return run


def _sets(k: int, held):
    """Shingle sets of the documents that the id filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_be_in(held.value, batch.column("doc_id"))))
            for part in slices(batch, "text"):
                sets = [x.tobytes() for x in shingle_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "tokens"])
        release()

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set of `left` shares with each of `right`."""
    sizes = [len(x) for x in left + right]
    column = np.unique(np.concatenate(left + right), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sizes)), sizes)
    held = np.bincount(column)
    number = np.cumsum(held > 1) - 1
    shared = held[column] > 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    n = int(number[-1]) + 1 if len(number) else 0
    for lo in range(0, n, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        dense = np.zeros((len(sizes), min(COLUMNS, n - lo)), np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out.astype(np.int64)


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
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


def _verified(percent: int):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("doc_id").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        ids, block = group.column("doc_id").to_numpy(), group.column("block").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("tokens").to_pylist()]
        left = np.flatnonzero(block == low)
        right = np.flatnonzero(block == high)
        x = y = np.zeros(0, np.int64)
        if len(left) and len(right) and len(ids) > 1:
            common = overlaps([sets[i] for i in left], [sets[i] for i in right])
            size = np.array([len(s) for s in sets], np.int64)
            union = size[left][:, None] + size[right][None, :] - common
            a, b = np.nonzero((100 * common >= percent * union) & (left[:, None] != right[None, :]))
            x, y = left[a], right[b]
        root = forest(len(ids), x, y)
        hit = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[hit], "b": ids[root[hit]]})

    return run


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`: the set's size and the smallest doc_id reachable over
    links, itself included.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z in lower case; a set holds the distinct shingles of k words, or the whole
    sequence where there are fewer. Two documents link when 100 * overlap >= percent * union. Null and empty texts have
    empty sets and no links. Equal rows stay as they are; a null doc_id is returned as its own null component and
    links nothing. An empty table gives an empty result; other columns are ignored. No link is lost: hashes of
    64 bits stand for shingles, and copies of one set are one node.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = docs.sparkSession.sparkContext.broadcast(frequency_ranks(slim, k))
    seen = written(slim.mapInArrow(_prefixes(ranks, k, percent), "doc_id long, n_shingles long, digest binary, head array<long>, bits binary"), "prefixes", "zstd")
    nodes = seen.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # One document of each class: the smallest id.
    least = F.min(F.struct("doc_id", "n_shingles", "head", "bits")).alias("first")
    reps = written(nodes.groupBy("digest").agg(least).select("digest", F.col("first.doc_id").alias("rep"), "first.n_shingles", "first.head", "first.bits"), "reps", "zstd")
    told = written(seen.select("doc_id", "n_shingles", "digest"), "told", "zstd")
    discard(seen)
    classes = reps.select("digest", "rep")
    tokens = reps.select("rep", F.explode("head").alias("token"))
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("rep").alias("hub")).where("df > 1"), "shared", "zstd")
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (4 * shared.count()).bit_length()))
    several = docs.sparkSession.sparkContext.broadcast(id_filter(shared.select("token"), bits))
    # Written, so that the join reads two plain shuffles and Spark can split a common shingle over tasks.
    posted = written(reps.mapInArrow(_posted(percent, several), "rep long, n_shingles long, token long, level int"), "posted", "zstd")
    live = written(posted.join(shared, "token"), "postings", "zstd")
    discard(posted)
    rare = live.where(F.col("df") <= COMMON)
    # The candidates that a document meets with l matches, from its postings: those of its first levels, shared by l.
    met = [F.coalesce(F.sum(F.when(F.col("level") <= i, F.col("df") - 1)), F.lit(0)) for i in range(1, LEVELS + 1)]
    cost = [m + F.first("n_shingles") / 64 * m / i for i, m in enumerate(met, 1)]
    chosen = rare.groupBy("rep").agg(*[c.alias(f"c{i}") for i, c in enumerate(cost, 1)])
    least = F.least(*[F.col(f"c{i}") for i in range(1, LEVELS + 1)])
    need = F.coalesce(*[F.when(F.col(f"c{i}") == least, i) for i in range(1, LEVELS + 1)])
    chosen = written(chosen.select("rep", need.alias("need")), "chosen", "zstd")
    side = rare.join(chosen, "rep").where("level <= need").select("token", "rep", "n_shingles", "level", "need")
    a, b = side.alias("a"), side.alias("b")
    both = F.least("a.need", "b.need")
    fits = (F.col("a.rep") < F.col("b.rep")) & (100 * F.least("a.n_shingles", "b.n_shingles") >= percent * F.greatest("a.n_shingles", "b.n_shingles")) & (F.col("a.level") <= both) & (F.col("b.level") <= both)
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & fits).groupBy(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).agg(F.count("*").alias("n"), F.first(both).alias("need")).where("n >= need").select("a", "b")
    own = lambda id_, n, parities: reps.select(F.col("rep").alias(id_), F.col("n_shingles").alias(n), F.col("bits").alias(parities))
    pairs = written(pairs, "pairs", "zstd").join(own("a", "n", "x"), "a").join(own("b", "m", "y"), "b").mapInArrow(_near(percent), "a long, b long")
    # A pair that misses no match of rare shingles only shares a common one, at the levels of both.
    common = live.where(F.col("df") > COMMON).join(chosen, "rep", "left").where(F.col("level") <= F.coalesce("need", F.lit(1))).select("token", "rep", "df", "hub")
    common = written(common, "common", "zstd")
    stars = common.where(F.col("df") > CROWDED).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    parts = F.ceil(F.col("df") / PARITY_DOCS).cast("int")
    met = common.where(F.col("df") <= CROWDED).select("token", "rep", parts.alias("parts"), F.pmod(F.xxhash64("rep"), parts).cast("int").alias("block")).join(reps.select("rep", "n_shingles", "bits"), "rep")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("token", "rep", "n_shingles", "bits", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    likely = met.groupBy("token", "low", "high").applyInArrow(_near_in(percent), "a long, b long")
    groups = written(components(pairs.union(likely).union(stars)), "groups")
    counted = groups.groupBy("component_id").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK_DOCS).cast("int"))
    placed = groups.join(counted, "component_id").select(F.col("id").alias("doc_id"), F.col("component_id").alias("bundle"), "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    held = docs.sparkSession.sparkContext.broadcast(id_filter(groups.select("id")))
    one = slim.mapInArrow(_sets(k, held), "doc_id long, tokens binary").join(placed, "doc_id")
    dealt = one.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("doc_id", "tokens", "bundle", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    links = written(dealt.groupBy("bundle", "low", "high").applyInArrow(_verified(percent), "a long, b long"), "links")
    joined = components(links).withColumnRenamed("id", "rep")
    discard(live)
    named = classes.join(joined, "rep", "left").select(F.col("digest").alias("set_digest"), F.coalesce("component_id", "rep").alias("component_id"))
    linked = (F.col("digest") == F.col("set_digest")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return told.join(named, linked, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stand for their component: those of the smallest doc_id.

    Rows with null or empty text, or a null doc_id, are components of their own and stay. All columns are kept.
    """
    found = jaccard_components(docs, k, percent).where(F.col("doc_id").isNotNull())
    gone = written(found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("kept")).where("NOT kept").select(F.col("doc_id").alias("gone_id")), "gone")
    # Only rows that the filter does not clear are shuffled, so the texts that stay mostly don't move.
    held = docs.sparkSession.sparkContext.broadcast(id_filter(gone))
    may_go = F.arrow_udf(lambda ids: pa.array(may_be_in(held.value, ids)), "boolean")(docs["doc_id"].cast("long"))
    doubtful = docs.where(may_go)
    return docs.where(~may_go).unionByName(doubtful.join(gone, doubtful["doc_id"].cast("long") == gone["gone_id"], "left_anti"))


#: All pairs that share a shingle, and components by recursion: for small tables.
ORACLE = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words
), sizes AS (
    SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN shingles USING (doc_id) GROUP BY d.doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT b.y, reach.r FROM reach JOIN ways b ON b.x = reach.doc_id
)
SELECT doc_id, n AS n_shingles, (SELECT min(r) FROM reach WHERE reach.doc_id = sizes.doc_id) AS component_id FROM sizes
"""
