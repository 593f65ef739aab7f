"""Scans, order statistics, batches and joins by ranges, against brute force, with many ranges and with one key for all rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlake.operators import ranges

PARTS = [1, 7, 40]


def some_rows(spark, n=1500, keys=3, seed=1):
    """Keys of very different size, one of which is null; ties of time; nulls in time and value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.choice([None, "a", "b"][:keys] + ["hot"] * 6)
        rows.append((i, k, None if rng.random() < 0.02 else rng.randrange(600), None if rng.random() < 0.3 else rng.randrange(50), rng.random() < 0.4))
    return rows, spark.createDataFrame(rows, "id long, k string, t long, v long, f boolean")


def in_order(dealt):
    """The rows of each key in the order that the ranges hold."""
    out = defaultdict(list)
    for r in sorted(dealt.frame.collect(), key=lambda r: (r["t"] is None, r["t"] or 0, r[ranges.TIE])):
        out[r["k"]].append(r)
    return out


@pytest.mark.parametrize("parts", PARTS)
def test_scans_equal_a_loop(spark, parts):
    _, rows = some_rows(spark)
    dealt = ranges.deal(rows, ["k"], "t", parts=parts)
    assert dealt.frame.select(ranges.RANGE).distinct().count() >= min(parts, 20)
    done = dealt.scan(s=ranges.total(F.col("v")), s0=ranges.total(F.col("v"), False), m=ranges.most(F.col("v")), m0=ranges.most(F.col("v"), False), w=ranges.known(F.col("v")), b=ranges.before(F.col("v")))
    for rows_ in in_order(done).values():
        s, m, w, b = 0, None, None, None
        for r in rows_:
            assert (r["s0"], r["m0"], r["b"]) == (s, m, b)
            v = b = r["v"]
            if v is not None:
                s, m, w = s + v, v if m is None else max(m, v), v
            assert (r["s"], r["m"], r["w"]) == (s, m, w)


@pytest.mark.parametrize("parts", PARTS)
def test_scans_without_a_key_and_descending(spark, parts):
    rows, frame = some_rows(spark)
    done = ranges.deal(frame, [], ("t", True), parts=parts).scan(n=ranges.total(F.lit(1)), m=ranges.most(F.col("v"))).frame.collect()
    done.sort(key=lambda r: (r["t"] is None, -(r["t"] or 0), r[ranges.TIE]))
    m = None
    for i, r in enumerate(done):
        m = r["v"] if m is None else m if r["v"] is None else max(m, r["v"])
        assert (r["n"], r["m"]) == (i + 1, m)
    with pytest.raises(ValueError):
        ranges.deal(frame, [], ("t", True)).scan(w=ranges.known(F.col("v"))).rows().collect()


@pytest.mark.parametrize("parts", PARTS)
def test_sequencing_equals_windows(spark, parts):
    from spanlake.operators import windows

    rng = random.Random(5)
    data = [(i, rng.choice("aab"), t, rng.random() < 0.5, rng.randrange(4)) for i, t in enumerate(rng.sample(range(100_000), 900))]
    rows = spark.createDataFrame(data, "id long, k string, t long, f boolean, m long")
    same = lambda a, b: sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))
    by = ["k"]
    assert same(ranges.running_count(rows, F.col("f"), by, "t", out="n", parts=parts), rows.withColumn("n", windows.running_count(F.col("f"), by, "t")))
    assert same(ranges.rank_by_first_seen(rows, by, "m", "t", "n", parts=parts), windows.rank_by_first_seen(rows, by, "m", "t", "n"))
    assert same(ranges.gaps(rows, by, "t", 120, ["f"], parts=parts), windows.gaps(rows, by, "t", 120, ["f"]))
    assert same(ranges.islands_by_flag(rows, "f", by, "t", "n", parts=parts), windows.islands_by_flag(rows, "f", by, "t", "n"))
    assert same(ranges.gap_groups(rows, by, "t", 90, "n", parts=parts), windows.gap_groups(rows, by, "t", 90, "n"))


def test_empty_tables(spark):
    _, rows = some_rows(spark, 30)
    none = rows.limit(0)
    assert ranges.deal(none, ["k"], "t").scan(s=ranges.total(F.col("v")), b=ranges.before(F.col("v"))).rows().count() == 0
    assert ranges.exact_percentiles(none, ["k"], "v", [0.5]).count() == 0


@pytest.mark.parametrize("parts", PARTS)
def test_percentiles_equal_numpy(spark, parts):
    rows, frame = some_rows(spark, 2000)
    got = {r["k"]: r for r in ranges.exact_percentiles(frame, ["k"], "t", [0, 0.5, 0.95, 1], parts=parts).collect()}
    for k in {r[1] for r in rows}:
        t = np.array([r[2] for r in rows if r[1] == k and r[2] is not None], float)
        r = got[k]
        assert r["samples"] == len(t) and r["largest"] == t.max()
        assert np.allclose([r[f"p{i}"] for i in range(4)], np.quantile(t, [0, 0.5, 0.95, 1]))
    one = ranges.exact_percentiles(spark.createDataFrame([("x", 5.0), ("y", None)], "k string, v double"), ["k"], "v", [0.5]).collect()
    assert [tuple(r) for r in one] == [("x", 1, 5.0, 5.0)]
    same = ranges.exact_percentiles(spark.range(5000).selectExpr("'h' AS k", "CAST(id % 3 AS DOUBLE) AS v"), ["k"], "v", [0.5, 0.95], parts=parts).first()
    assert (same["p0"], same["p1"], same["samples"]) == (1.0, 2.0, 5000)


# quality, joins and batches over ranges


@pytest.mark.parametrize("parts", PARTS)
def test_inversions_and_overlaps_equal_brute_force(spark, parts):
    from spanlake.operators import quality

    rng = random.Random(parts)
    rows = [(rng.randrange(400), rng.randrange(90), "x" * rng.randrange(200)) for _ in range(1500)] + [(None, 1, ""), (3, None, "")]
    best = defaultdict(lambda: -1)
    for r, s, _ in rows:
        if r is not None and s is not None:
            best[r] = max(best[r], s)
    worse, so_far = {}, None
    for r in sorted(best, reverse=True):
        worse[r] = so_far
        so_far = best[r] if so_far is None else max(so_far, best[r])
    want = sorted((r, s, x, worse[r]) for r, s, x in rows if r is not None and s is not None and worse[r] is not None and s < worse[r])
    frame = spark.createDataFrame(rows, "r int, s int, wide string")
    assert sorted(tuple(r) for r in quality.rank_inversions(frame, "r", "s", parts=parts).collect()) == want
    spans = [(i, "k", s, s + rng.randrange(30)) for i, s in enumerate(rng.sample(range(20_000), 700))]
    latest, lapped = None, set()
    for i, _, s, e in sorted(spans, key=lambda x: x[2:]):
        if latest is not None and s <= latest:
            lapped.add((i, latest))
        latest = e if latest is None else max(latest, e)
    got = quality.overlapping_intervals(spark.createDataFrame(spans, "i long, k string, s long, e long"), ["k"], "s", "e", parts=parts)
    assert {(r["i"], r["latest_end"]) for r in got.collect()} == lapped


@pytest.mark.parametrize("advised", ["64MB", "1MB", "100KB"])
def test_inversions_of_a_million_wide_rows(spark, advised):
    """The result does not depend on how Spark cuts the ranges."""
    from spanlake.operators import quality

    n = 1_000_000
    wide = spark.range(n).selectExpr("id AS r", "(id * 7919) % 1000003 AS s", "repeat(CAST(id AS STRING), 4) AS wide", "id * 2.5 AS x")
    score = np.arange(n) * 7919 % 1000003
    top = np.concatenate([np.maximum.accumulate(score[::-1])[::-1][1:], [-1]])
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, advised)
    try:
        got = quality.rank_inversions(wide, "r", "s").agg(F.count("*").alias("n"), F.sum("best_after").alias("b"), F.sum("r").alias("r")).first()
    finally:
        spark.conf.set(key, before)
    low = score < top
    assert tuple(got) == (int(low.sum()), int(top[low].sum()), int(np.flatnonzero(low).sum()))


def test_dyadic_nodes_cover_each_interval_once(spark):
    from spanlake.operators import joins

    rng = random.Random(9)
    spans = [(s, s + rng.choice([0, 1, 2, 7, 1000, 10**12])) for s in (rng.randrange(-(10**6), 10**6) for _ in range(200))] + [(5, 4), (None, 3), (0, 2**40 - 1)]
    rows = spark.createDataFrame(spans, "s long, e long").select("s", "e", joins.dyadic_nodes(F.col("s"), F.col("e")).alias("n")).collect()
    for r in rows:
        if r["s"] is None or r["s"] > r["e"]:
            assert not r["n"]
            continue
        at = r["s"]
        for a, b in sorted((n["node"] << n["level"], (n["node"] + 1) << n["level"]) for n in r["n"]):
            assert a == at
            at = b
        assert at == r["e"] + 1 and len(r["n"]) <= 2 * max(1, (r["e"] - r["s"] + 1).bit_length())


@pytest.mark.parametrize("grain", [0, 3, 10])
def test_points_meet_their_intervals_once(spark, grain):
    from spanlake.operators import joins

    rng = random.Random(grain)
    points = [(i, rng.choice("hhhk"), rng.randrange(-5000, 5000)) for i in range(400)] + [(999, "h", None), (998, None, 1)]
    spans = [(i, rng.choice("hhhk"), s, s + rng.choice([0, 3, 90, 4000, -5])) for i, s in enumerate(rng.choices(range(-5000, 5000), k=150))]
    want = sorted((p, i) for p, k, t in points for i, j, s, e in spans if t is not None and k == j and s - 7 <= t <= e + 7)
    a, b = spark.createDataFrame(points, "p long, k string, t long"), spark.createDataFrame(spans, "i long, k string, s long, e long")
    found = joins.within_dyadic(a, b, ["k"], "t", "s", "e", 7, grain)
    assert found.columns == ["p", "k", "t", "i", "s", "e"] and sorted((r["p"], r["i"]) for r in found.collect()) == want
    assert joins.within_dyadic(a, b.limit(0), ["k"], "t", "s", "e").count() == 0


@pytest.mark.parametrize("parts", PARTS)
def test_sorted_as_of_equals_the_join(spark, parts):
    from spanlake.operators import joins

    rng = random.Random(parts)
    versions = []
    for k in ("hot", "b", "c"):
        at = 0
        for i in range(300 if k == "hot" else 5):
            at += rng.randrange(1, 9)
            versions.append((k, f"{k}{i}", at, rng.choice([at + 1, None]) if i % 7 == 3 else None))
    by_key = defaultdict(list)
    for v in versions:
        by_key[v[0]].append(v)
    closed = [(k, n, a, min([x for x in (u, vs[j + 1][2] if j + 1 < len(vs) else None) if x is not None], default=None)) for k, vs in by_key.items() for j, (_, n, a, u) in enumerate(vs)]
    facts = [(i, rng.choice(["hot"] * 5 + ["b", "c", "none"]), rng.randrange(1500)) for i in range(1200)] + [(5000, None, 3), (5001, "hot", None)]
    f, v = spark.createDataFrame(facts, "id long, k string, t long"), spark.createDataFrame(closed, "m string, name string, valid_from long, valid_to long")
    for how in ("inner", "left"):
        want = sorted(((r["id"], r["name"]) for r in joins.as_of(f, v, f["k"] == v["m"], f["t"], how=how).collect()), key=repr)
        got = joins.as_of_sorted(f, v, ("k", "m"), "t", how=how, parts=parts)
        assert sorted(((r["id"], r["name"]) for r in got.collect()), key=repr) == want
    assert got.columns == ["id", "k", "t", "m", "name", "valid_from", "valid_to"]


@pytest.mark.parametrize("parts, seed", [(1, 1), (7, 2), (40, 3)])
def test_batches_equal_next_fit(spark, parts, seed):
    from spanlake.plans import export

    rng = random.Random(seed)
    records = [(None if i % 97 == 5 else i // 2, "x" * rng.choice([0, 1, 5, 49, 60, 90, 100, 101, 250, 3000]) + str(i)) for i in range(900)] + [(3, None)]
    got = export.batched(spark.createDataFrame(records, "at_ms long, json string"), most=140, wrapper=20, parts=parts).collect()
    held = defaultdict(list)
    for r in got:
        held[r["batch"]].append((r["at_ms"] is None, r["at_ms"] or 0, r["json"]))
    want, size = [], None
    for t, j in sorted((r for r in records if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        if size is None or size + 1 + len(j) > 140:
            want.append([])
            size = 20 + len(j)
        else:
            size += 1 + len(j)
        want[-1].append((t is None, t or 0, j))
    assert [sorted(held[b]) for b in sorted(held)] == want and sorted(held) == list(range(len(want)))
    assert export.batched(spark.createDataFrame([], "at_ms long, json string"), 100).count() == 0


def test_no_payload_is_over_the_limit(spark):
    import json

    from spanlake.plans import export

    rows = spark.range(200).selectExpr("id AS at_ms", "to_json(struct(id, repeat('é', CAST(id % 50 AS INT)) AS t)) AS json")
    made = export.payloads(rows, "events", 120).orderBy("batch").collect()
    assert all(len(p["payload"].encode()) <= 120 or p["records"] == 1 for p in made)
    assert [r["id"] for p in made for r in json.loads(p["payload"])] == list(range(200))


@pytest.mark.parametrize("block", [5, 40, 10_000])
@pytest.mark.parametrize("slack", [0, 7])
def test_counts_within_intervals_equal_brute_force(spark, block, slack):
    from spanlake.operators import joins

    rng = random.Random(block)
    points = [(rng.choice([None, "a", *["hot"] * 6]), None if rng.random() < 0.02 else rng.randrange(-300, 900), None if rng.random() < 0.05 else rng.randrange(12)) for _ in range(700)]
    spans = [(i, rng.choice([None, "a", "none", *["hot"] * 6]), s := rng.randrange(-300, 900), None if rng.random() < 0.02 else s + rng.choice([-9, -1, 0, 3, 40, 700])) for i in range(300)]
    p = spark.createDataFrame(points, "k string, t long, m long").repartition(5)
    i = spark.createDataFrame(spans, "id long, k string, s long, e long").repartition(3)
    found = joins.counted_within(p, i, ["k"], "t", "m", "s", "e", slack, block)
    assert found.columns == ["id", "k", "s", "e", "n", "members"]
    want = set()
    for id_, k, s, e in spans:
        inside = [m for pk, t, m in points if None not in (k, t, e) and pk == k and s - slack <= t <= e + slack]
        if inside:
            want.add((id_, len(inside), len({m for m in inside if m is not None})))
    got = [(r["id"], r["n"], r["members"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert joins.counted_within(p, i.limit(0), ["k"], "t", "m", "s", "e").count() == joins.counted_within(p.limit(0), i, ["k"], "t", "m", "s", "e").count() == 0


def test_counts_within_intervals_make_no_pairs(spark):
    """20,000 points in each of 20,000 intervals: 400 million pairs, told by counts; the plans hold no row for a pair."""
    from spanlake.operators import joins

    p = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 100).alias("m"))
    i = spark.range(20_000).select("id", F.lit(1).alias("k"), F.lit(0).alias("s"), F.lit(19_999).alias("e"))
    found = joins.counted_within(p, i, ["k"], "t", "m", "s", "e", block=4096).groupBy("n", "members").count().collect()
    assert [tuple(r) for r in found] == [(20_000, 100, 20_000)]
