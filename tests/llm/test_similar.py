"""Operators 1, 3, 4, 5 and 7 against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import empty, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanlake.llm import ann, jaccard_join, line_dedup, near_vectors, passages, queries
from spanlake.llm.components import components
from spanlake.llm.idfilter import likely_in


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (300, None)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    union = Union()
    for a, b in links:
        if a is not None and b is not None and a != b:
            union.join(a, b)
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x in union.up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_id_filter_loses_none(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id")).union(spark.createDataFrame([(None,)], "doc_id long"))
    kept = {r.doc_id for r in likely_in(rows, spark.range(0, 2000, 7)).collect()}
    assert set(range(0, 2000, 7)) <= kept and len(kept) < 400
    assert likely_in(rows, spark.range(0)).count() == 0


# 4


def shingle_set(text, k):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_jaccard(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
    union = Union()
    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(ids[x], ids[y])
    return sorted((i, len(shingle_set(t, k)), union.find(i)) for i, t in rows if i is not None)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("clash", [False, True])
def test_jaccard_on_awkward_rows(spark, k, percent, clash):
    docs = table(spark, clash=clash)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard_join.jaccard_components(docs, k, percent).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute_jaccard(rows, k, percent)
    assert sorted(r.component_id is None for r in got if r.doc_id is None) == [True, True]


@pytest.mark.parametrize("common, block", [(2, 4), (32, 256)])
def test_jaccard_with_families_and_common_passages(spark, monkeypatch, common, block):
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(25)]
    rows = []
    for family in range(6):
        base = [rng.choice(words) for _ in range(rng.choice((12, 40, 150)))]
        for _ in range(rng.choice((3, 25))):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(text + (passage if family % 2 else []))
    rows = [(i, " ".join(t)) for i, t in enumerate(rows + [[rng.choice(words) for _ in range(30)] + passage for _ in range(20)])]
    for k, percent in ((3, 90), (5, 80)):
        got = sorted(tuple(r) for r in jaccard_join.jaccard_components(table(spark, rows), k, percent).collect())
        assert got == brute_jaccard(rows, k, percent)


def test_parities_lose_no_link():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 90):
        for _ in range(300):
            core = rng.integers(0, 1 << 63, int(rng.choice([3, 60, 66, 130, 700, 20_000 if percent == 90 else 90]))).astype(np.uint64)
            x = np.unique(np.concatenate([core, rng.integers(0, 1 << 63, rng.integers(0, len(core) // 2 + 2)).astype(np.uint64)]))
            y = np.unique(core[: rng.integers(len(core) // 2, len(core) + 1)])
            if 100 * len(np.intersect1d(x, y)) < percent * len(np.union1d(x, y)):
                continue
            bits = pa.array([jaccard_join.parity(x), jaccard_join.parity(y)], pa.binary())
            least = min(len(b.as_py()) for b in bits) // 8
            a, b = (jaccard_join._folded(bits, np.array([i]), least) for i in (0, 1))
            assert jaccard_join.may_link(np.array([len(x)]), np.array([len(y)]), np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64), percent)[0]


def test_jaccard_candidates_dont_join_by_chance(spark, monkeypatch):
    """Texts of few different words share shingles of their prefixes by chance, which joined nearly all of them in one group to be compared whole."""
    sizes, true = [], jaccard_join.id_filter
    monkeypatch.setattr(jaccard_join, "id_filter", lambda ids, *bits: (sizes.append(ids.count()) if ids.columns == ["id"] else None, true(ids, *bits))[1])
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghijkl") for _ in range(150))) for i in range(1000)]
    rows += [(1000 + i, rows[i][1] + " z") for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(table(spark, rows), 3, 90).collect()}
    assert sizes == [80]
    assert got == {i: i - 1000 if i >= 1000 else i for i in range(1040)}


@pytest.mark.parametrize("crowded, docs", [(8, 1024), (4096, 3)])
def test_jaccard_of_common_shingles_in_blocks(spark, monkeypatch, crowded, docs):
    for name, value in (("COMMON", 2), ("CROWDED", crowded), ("PARITY_DOCS", docs)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(11)
    bases = [[f"w{rng.randrange(4000)}" for _ in range(70)] for _ in range(4)]
    rows = []
    for i in range(90):
        text = list(bases[i % 4])
        for _ in range(rng.randrange(0, 3)):
            text[rng.randrange(70)] = f"v{rng.randrange(500)}"
        rows.append((i, " ".join(text)))
    for k, percent in ((3, 90), (5, 80)):
        assert sorted(tuple(r) for r in jaccard_join.jaccard_components(table(spark, rows), k, percent).collect()) == brute_jaccard(rows, k, percent)


def test_one_of_each_keeps_the_smallest_and_all_columns(spark):
    docs = table(spark, clash=True)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 10, 12, 14, 15, 16, 17, 17, 18, 19] and ids.count(None) == 2
    assert jaccard_join.one_of_each(empty(spark)).count() == 0


def test_one_of_each_moves_few_texts(spark):
    """Texts that stay are not shuffled: the one exchange of texts is that of those which may go, below the filter of ids."""
    kept = jaccard_join.one_of_each(table(spark))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    before, after = plan.split("Join LeftAnti")
    assert "Union" in before and "text" in after and "ArrowEvalPython" in before and "ArrowEvalPython" in after and "LeftSemi" not in plan


def test_overlap_bound():
    assert [jaccard_join.least_overlap(n, 90) for n in (1, 9, 10, 11, 100)] == [1, 9, 9, 10, 90]


# 5


def brute_lines(rows, lines, words=None):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, gone, out = set(), defaultdict(set), {}
    done = {}
    for i in order:
        doc, text = rows[i]
        if text is None:
            continue
        if (doc, text) in done:
            gone[i] = gone[done[doc, text]]
            continue
        done[doc, text] = i
        parts = text.split("\n")
        for at in range(len(parts) - lines + 1):
            run = tuple(parts[at : at + lines])
            if run in seen:
                gone[i] |= set(range(at, at + lines))
            seen.add(run)
        for at, line in enumerate(parts if words else ()):
            if re.search(rf"(\S+\s+){{{words - 1}}}\S", line, re.ASCII):
                if (line,) in seen:
                    gone[i].add(at)
                seen.add((line,))
    for i, (doc, text) in enumerate(rows):
        out[i] = None if text is None else "\n".join(p for j, p in enumerate(text.split("\n")) if j not in gone[i])
    return out


@pytest.mark.parametrize("lines", [2, 3, 4, 5])
def test_lines_against_brute_force(spark, lines):
    rng = random.Random(lines)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "solo"), (3, rows[3][1])]
    docs = table(spark, rows)
    got = line_dedup.dedup_lines(docs, lines)
    want = brute_lines(rows, lines)
    assert sorted((r.doc_id, r.text is None, r.text or "") for r in got.collect()) == sorted((d, want[i] is None, want[i] or "") for i, (d, _) in enumerate(rows))


def test_lines_on_awkward_rows(spark):
    docs = table(spark, clash=True).drop("n_lines", "n_deleted")
    got = line_dedup.dedup_lines(docs, 2)
    assert got.columns == [*docs.columns, "n_lines", "n_deleted", "longest_run"] and got.count() == docs.count()
    texts = {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in got.where("doc_id BETWEEN 14 AND 16").collect()}
    assert texts == {14: ("a\nb\nc\nd", 4, 0), 15: ("z\nq", 6, 4), 16: ("", 2, 2)}
    assert got.where("text IS NULL").count() == 2 and line_dedup.dedup_lines(empty(spark), 2).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, 1)


def test_single_lines_that_are_long_enough_go_whatever_their_neighbours(spark):
    rng, long, short = random.Random(6), "this line has five words", "only three words"
    rows = [(i, "\n".join(x for j in range(rng.randrange(1, 5)) for x in (f"own {i} {j}", rng.choice((long, short, "  this has  four\twords "))))) for i in range(40)]
    want, seen = [], set()
    for i, text in rows:
        left = []
        for line in text.split("\n"):
            if len(line.split()) < 4 or line not in seen:
                left.append(line)
            seen.add(line)
        want.append((i, "\n".join(left)))
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(table(spark, rows), 2, line_words=4).collect()) == want
    assert sum(line_dedup.dedup_lines(table(spark, rows)).toPandas().n_deleted) == 0


def brute_longest(rows, lines):
    """For each row the greatest length among `lines` and powers of two above it at which a run of it stood before."""
    texts = sorted(((d, t) for d, t in rows), key=lambda r: r[0])
    lengths, out = [lines] + [2**k for k in range(12) if 2**k > lines], {}
    for n in lengths:
        seen = set()
        for doc, text in texts:
            parts = text.split("\n")
            for at in range(len(parts) - n + 1):
                run = tuple(parts[at : at + n])
                if run in seen:
                    out[doc] = n
                seen.add(run)
    return {d: out.get(d, 0) for d, _ in rows}


@pytest.mark.parametrize("lines", [2, 3, 4, 7])
def test_doubling_goes_on_to_the_longest_run(spark, lines):
    rng = random.Random(lines)
    long = [rng.choice("abcdef") for _ in range(150)]
    rows = [(i, "\n".join([*(rng.choice("abcdef") for _ in range(rng.randrange(3))), *long[rng.randrange(60) : rng.randrange(60, 150)], f"own {i}"])) for i in range(25)]
    got = line_dedup.dedup_lines(table(spark, rows), lines)
    assert {r.doc_id: r.longest_run for r in got.collect()} == brute_longest(rows, lines)


def test_intervals_hold_all_places_of_a_run_and_its_first(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (2, "x\na\nb\nc\nd\ny"), (3, "q\nb")]
    got = {n: {(r.doc, r.at, r["first"].doc, r["first"].at) for r in places.collect()} for n, places in line_dedup.intervals(table(spark, rows))}
    assert got == {
        1: {(1, 0, 1, 0), (1, 1, 1, 1), (1, 2, 1, 2), (1, 3, 1, 3), (2, 1, 1, 0), (2, 2, 1, 1), (2, 3, 1, 2), (2, 4, 1, 3), (3, 1, 1, 1)},
        2: {(1, 0, 1, 0), (1, 1, 1, 1), (1, 2, 1, 2), (2, 1, 1, 0), (2, 2, 1, 1), (2, 3, 1, 2)}, 4: {(1, 0, 1, 0), (2, 1, 1, 0)},
    }


# 3


def test_passages_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(80)]
    rows, want = [], set()
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(50, 300))]
        if i % 3 == 0:
            p = list(base)
            for _ in range(rng.randint(0, 4)):
                j, kind = rng.randrange(len(p)), rng.random()
                p[j : j + 1] = [rng.choice(words)] if kind < 0.4 else [] if kind < 0.7 else [p[j], rng.choice(words)]
            at = rng.randint(0, len(text))
            text[at:at] = p
            want.add(i)
        rows.append((i, " ".join(text)))
    got = passages.repeated_passages(table(spark, rows, clash=True)).collect()
    assert {r.doc_id for r in got} | {r.source_id for r in got} == want and {r.doc_id for r in got} == want - {0}
    for r in got:
        a, b = rows[r.doc_id][1].split()[r.start : r.end], rows[r.source_id][1].split()[r.source_start : r.source_end]
        assert a[0] == b[0] and a[-1] == b[-1] and r.words >= 40 and r.identity >= 0.8


def test_passages_on_awkward_rows(spark):
    got = passages.repeated_passages(table(spark, clash=True))
    assert {(r.doc_id, r.source_id) for r in got.collect()} >= {(2, 1), (3, 1), (13, 1), (11, 10)}
    assert {r.doc_id for r in got.collect()} <= {2, 3, 11, 13}
    long = got.where("doc_id = 11").orderBy(F.desc("words")).first()
    assert (long.start, long.end) == (0, 30_000) and long.identity == 1.0
    assert passages.repeated_passages(empty(spark)).count() == 0


def test_passages_within_the_limits_are_found(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(20_000)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    rows, want = [], defaultdict(set)
    for size, same in ((50, 0.9), (50, 0.86), (60, 0.86), (60, 0.82), (80, 0.86), (80, 0.82)):
        while len(want[size, same]) < 60:
            base = draw(size)
            copy = [w if rng.random() < same else rng.choice(words) for w in base]
            equal = [i for i, (a, b) in enumerate(zip(base, copy)) if a == b]
            if len(equal) >= 40 and len(equal) >= 0.8 * (equal[-1] + 1 - equal[0]):
                n = len(rows)
                rows += [(n, " ".join(draw(70) + base + draw(70))), (n + 1, " ".join(draw(90) + copy + draw(50)))]
                want[size, same].add((n + 1, n))
    got = {(r.doc_id, r.source_id) for r in passages.repeated_passages(table(spark, rows)).collect()}
    recall = {case: len(pairs & got) / 60 for case, pairs in want.items()}
    assert min(recall.values()) >= 0.95 and got <= set().union(*want.values()), recall


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        left = 0
        for j, b in enumerate(y, 1):
            left, row[j] = row[j], left + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def edited(rng, base, share, draw):
    """The words with a share of them replaced, deleted or followed by a new one, in equal parts."""
    out = []
    for w in base:
        kind = rng.random() / share
        out += [w] if kind >= 1 else draw(1) if kind < 1 / 3 else [] if kind < 2 / 3 else [w, *draw(1)]
    return out


def test_passages_with_words_inserted_and_deleted_are_found(spark):
    rng = random.Random(21)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    rows, want = [], defaultdict(dict)
    for size, share in ((55, 0.08), (60, 0.12), (90, 0.12)):
        while len(want[size, share]) < 100:
            base = draw(size)
            copy = edited(rng, base, share, draw)
            same = lcs(base, copy)
            if same >= 40 and same >= 0.8 * max(len(base), len(copy)):
                n = len(rows)
                rows += [(n, " ".join(draw(70) + base + draw(70))), (n + 1, " ".join(draw(90) + copy + draw(50)))]
                want[size, share][n + 1, n] = same
    got = defaultdict(int)
    for r in passages.repeated_passages(table(spark, rows)).collect():
        got[r.doc_id, r.source_id] = max(got[r.doc_id, r.source_id], r.words)
    recall = {case: sum(p in got for p in pairs) / 100 for case, pairs in want.items()}
    told = {case: sum(got.get(p, 0) for p in pairs) / sum(pairs.values()) for case, pairs in want.items()}
    print(recall, told)
    assert min(recall.values()) >= 0.95 and min(told.values()) >= 0.93, (recall, told)
    assert set(got) <= {p for pairs in want.values() for p in pairs}


def local(x, y):
    """The best local alignment (equal 1, else -2): equal words and the longer side."""
    best, above = (0, 0, 0), [(0, 0, 0, 0)] * (len(y) + 1)
    for a in x:
        row = [(0, 0, 0, 0)]
        for j, b in enumerate(y, 1):
            s, n, u, v = above[j - 1]
            options = [(0, 0, 0, 0), (s + 1, n + 1, u + 1, v + 1) if a == b else (s - 2, n, u + 1, v + 1)]
            s, n, u, v = above[j]
            options.append((s - 2, n, u + 1, v))
            s, n, u, v = row[j - 1]
            options.append((s - 2, n, u, v + 1))
            row.append(max(options))
            best = max(best, (row[-1][0], row[-1][1], max(row[-1][2:])))
        above = row
    return best[1:]


def test_passages_of_sixty_documents_against_an_aligner_of_all_pairs(spark):
    """Every pair with a clear passage is found, and what is told of each passage holds between its ends."""
    rng = random.Random(33)
    draw = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    bases = [draw(rng.randint(60, 130)) for _ in range(4)]
    rows = []
    for n in range(60):
        text = draw(rng.randint(10, 60))
        for _ in range(rng.choice((0, 1, 1, 2))):
            base = rng.choice(bases)
            cut = rng.randrange(len(base) // 3)
            text += edited(rng, base[cut : cut + rng.randint(30, 130)], rng.choice((0.001, 0.05, 0.1)), draw) + draw(rng.randint(5, 40))
        rows.append((n, " ".join(text + draw(3) * rng.choice((1, 1, 12)))))
    words = [text.split() for _, text in rows]
    found = passages.repeated_passages(table(spark, rows)).collect()
    for r in found:
        a, b = words[r.doc_id][r.start : r.end], words[r.source_id][r.source_start : r.source_end]
        assert 40 <= r.words <= lcs(a, b) and r.identity == r.words / max(len(a), len(b)) >= 0.8
    reached = defaultdict(set)  # a passage of many documents is linked to two of them, the others by these
    for r in found:
        reached[r.doc_id].add(r.source_id)
    clear = set()
    for i in range(60):
        for j in range(i):
            n, size = local(words[i], words[j])
            if n >= 44 and n >= 0.85 * size:
                clear.add(i)
    assert clear and clear - set(reached) == set(), clear - set(reached)


def test_two_passages_with_much_between_them_are_both_found(spark):
    rng = random.Random(4)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    one, two = draw(200), draw(200)
    rows = [(i, " ".join(draw(30) + one + draw(900) + two + draw(30))) for i in range(2)]
    got = [(r.start, r.end, r.source_start, r.words) for r in passages.repeated_passages(table(spark, rows)).orderBy("start").collect()]
    assert got == [(30, 230, 30, 200), (1130, 1330, 1130, 200)]


def chains_on(words, src_words, chains, k):
    """The two sides of one pair as they are fetched for these chains (lists of places)."""
    sides = []
    for text, which in ((words, 0), (src_words, 1)):
        counts = np.array([len(c) for c in chains])
        at = np.array([p[which] for c in chains for p in c])
        ask, lo, hi = passages.stretches(np.array([0]), np.array([len(text)]), at, np.array([len(at)]), counts, np.array([len(counts)]), k)
        known = np.concatenate([text[a:b] for a, b in zip(lo, hi)]).astype(np.uint32)
        sides.append((at, passages.Side(np.zeros(len(lo), int), lo, hi - lo, np.cumsum(hi - lo) - (hi - lo), known)))
    return counts, *sides


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=70), st.lists(st.integers(0, 5), max_size=70))
def test_common_is_the_longest_common_subsequence(x, y):
    assert passages.common(np.array(x, np.uint32), np.array(y, np.uint32)) == lcs(x, y)


def test_ends_are_those_of_the_best_banded_alignment():
    rng = random.Random(6)
    draw = lambda n: [rng.randrange(50) for _ in range(n)]
    for _ in range(40):
        base = draw(rng.randint(0, 90))
        words, other = draw(10) + list(range(100, 106)) + base, draw(30) + list(range(100, 106)) + edited(rng, base, 0.1, draw)
        counts, (at, own), (src_at, src) = chains_on(np.array(words), np.array(other), [[(10, 30)]], 6)
        x, y = own.flank(np.array([0]), at + 6, 1, -1), src.flank(np.array([0]), src_at + 6, 1, -2)
        score, equal, i, j = (f[0] for f in passages.ends_of(x, y))
        a, b = words[16 : 16 + passages.FLANK], other[36 : 36 + passages.FLANK]
        cells = {(0, 0): 0}
        for u in range(len(a) + 1):
            for v in range(max(0, u - passages.BAND), min(len(b), u + passages.BAND) + 1):
                if u or v:
                    from_ = [cells[p] - passages.EDIT for p in ((u - 1, v), (u, v - 1)) if p in cells]
                    if (u - 1, v - 1) in cells:
                        from_.append(cells[u - 1, v - 1] + (1 if a[u - 1] == b[v - 1] else -passages.EDIT))
                    cells[u, v] = max(from_)
        assert score.max() == max(cells.values()) and cells[i[score.argmax()], j[score.argmax()]] == score.max()
        assert (equal <= np.minimum(i, j)).all() and (passages.most_common(x, y)[0] >= equal).all()


def test_passages_of_one_repeated_word_are_covered_by_few_rows(spark):
    got = passages.repeated_passages(table(spark, [(1, "a " * 200), (2, "a " * 900)])).collect()
    assert 900 - sum(r.end - r.start for r in got) < 0 < len(got) < 30
    assert set().union(*(range(r.start, r.end) for r in got)) == set(range(900))


def test_a_passage_of_two_parts_that_first_stood_apart_is_found(spark):
    rng = random.Random(9)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    rows, want = [], set()
    for _ in range(40):
        one, two, n = draw(30), draw(30), len(rows)
        rows += [(n + i, " ".join(draw(50) + p + draw(50))) for i, p in enumerate((one, two, one + two, one + two))]
        want.add((n + 3, n + 2, 60))
    got = {(r.doc_id, r.source_id, r.words) for r in passages.repeated_passages(table(spark, rows)).collect()}
    assert got == want


def test_an_identical_passage_is_found_though_pieces_of_it_stood_before(spark):
    rng = random.Random(13)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    passage = draw(120)
    rows = [(i, " ".join(draw(30) + passage[9 * i : 9 * i + 39] + draw(30))) for i in range(10)]
    rows += [(100, " ".join(draw(20) + passage + draw(20))), (101, " ".join(draw(40) + passage + draw(5)))]
    assert [(r.doc_id, r.source_id, r.words) for r in passages.repeated_passages(table(spark, rows)).collect()] == [(101, 100, 120)]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_seeds_link_to_their_first_place_and_the_document_before(spark, parts):
    rng = random.Random(parts)
    rows = sorted({(rng.choice((-5, 1, 2, 2, 2, 9)), rng.randrange(60), rng.randrange(8)) for _ in range(500)})
    held = defaultdict(lambda: defaultdict(list))
    for seed, doc, at in rows:
        held[seed][doc].append(at)
    want = []
    for docs in held.values():
        ids = sorted(docs)
        for before, doc in zip(ids, ids[1:]):
            want += {(doc, src, at, min(docs[src])) for src in (ids[0], before) for at in docs[doc]}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = [tuple(r) for r in passages.links_of(spark.createDataFrame(rows, "seed long, doc long, at int"), parts).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(want)


def test_all_documents_that_share_a_passage_are_linked_with_each_other(spark):
    rng = random.Random(17)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    passage, rows = draw(80), []
    for n in range(14):
        own = list(passage)
        own[rng.randrange(80)] = draw(1)[0]
        rows.append((n, " ".join(draw(70) + own + draw(70))))
    got = {(r.doc_id, r.source_id) for r in passages.repeated_passages(table(spark, rows)).collect()}
    assert got == {(i, j) for i in range(14) for j in range(i)}


def test_a_text_sends_its_words_to_few_cells_and_not_to_each_pair(spark, monkeypatch):
    rng = random.Random(22)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    passage, rows, sent = draw(80), [], []
    for n in range(40):
        own = list(passage)
        own[rng.randrange(80)] = draw(1)[0]
        rows.append((n, " ".join(draw(70) + own + draw(70))))
    frame = type(spark.range(0))

    def told(df, f, schema, *more, keep=frame.mapInArrow):
        out = keep(df, f, schema, *more)
        if schema == passages.CUT_SCHEMA:
            sent.append(out.agg(F.sum(F.length("words"))).first()[0])
        return out

    monkeypatch.setattr(frame, "mapInArrow", told)
    assert len({(r.doc_id, r.source_id) for r in passages.repeated_passages(table(spark, rows)).collect()}) == 780
    assert sent[0] <= 12 * 4 * 40 * 220, sent  # once for each pair would be up to 39 times


def test_a_passage_of_many_documents_is_one_class_with_few_rows(spark, tmp_path):
    rng = random.Random(23)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    rows = []
    for size in (20, 40):  # two families, in turn
        passage = draw(80)
        for _ in range(size):
            own = list(passage)
            own[rng.randrange(80)] = draw(1)[0]
            rows.append(" ".join(draw(70) + own + draw(70)))
    rows = [(2 * n if n < 20 else 2 * n - 39, text) for n, text in enumerate(rows)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_passages(spark, str(tmp_path)).collect()
    assert {(r.doc_id % 2 if r.doc_id < 40 else 1, r.class_id) for r in got} == {(0, 0), (1, 1)}
    assert {r.doc_id for r in got} == {n for n, _ in rows} - {0, 1}
    assert len(got) <= 6 * len(rows), len(got)  # 190 + 780 pairs


def test_places_in_different_classes_are_compared_all_with_all(spark):
    """Two documents share a line with many others, and with each other alone the words after it, which keep no run of 6."""
    rng = random.Random(24)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    line, after = draw(22), draw(60)
    rows = []
    for n in range(40):
        tail = [w if i % 6 != 2 else draw(1)[0] for i, w in enumerate(after)] if n in (10, 30) else draw(60)
        rows.append((n, " ".join(draw(70) + line + tail + draw(70))))
    got = [(r.doc_id, r.source_id, r.class_id) for r in passages.passage_classes(table(spark, rows)).collect()]
    assert got == [(30, 10, 10)]


@pytest.mark.parametrize("most", [64, 6])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, most):
    rng = random.Random(25)
    draw = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    bases = [draw(rng.randint(60, 130)) for _ in range(5)]
    rows = []
    for n in range(60):
        text = draw(rng.randint(10, 60))
        for base in rng.sample(bases, rng.choice((0, 1, 1, 2))):
            text += edited(rng, base, rng.choice((0.001, 0.05, 0.1)), draw) + draw(rng.randint(70, 90))
        rows.append((n, " ".join(text)))
    rows += [(70, rows[5][1]), (71, "")]
    pairs = passages.repeated_passages(table(spark, rows)).collect()  # all with all
    monkeypatch.setattr(passages, "MOST", most)
    got = passages.passage_classes(table(spark, rows)).collect()
    classes = defaultdict(list)
    for r in got:
        if r.class_id is not None:
            classes[r.doc_id].append((r.start, r.end, (r.class_id, r.class_start)))
            classes[r.source_id].append((r.source_start, r.source_end, (r.class_id, r.class_start)))
    of = lambda doc, at: {c for start, end, c in classes[doc] if start <= at < end}
    for r in pairs:
        if r.doc_id != 70:
            assert of(r.doc_id, (r.start + r.end) // 2) & of(r.source_id, (r.source_start + r.source_end) // 2), r
    assert len({c for held in classes.values() for *_, c in held}) == 5 and len(got) < len(pairs)
    assert [(r.source_id, r.class_id) for r in got if r.doc_id == 70] == [(r.source_id, None) for r in pairs if r.doc_id == 70]


def test_classes_on_awkward_rows(spark):
    got = passages.passage_classes(table(spark, clash=True))
    assert {(r.doc_id, r.source_id) for r in got.collect()} >= {(2, 1), (3, 1), (13, 1), (11, 10)}
    assert passages.passage_classes(empty(spark)).count() == 0


def test_a_passage_of_common_lines_is_found_by_pairs_of_their_seeds(spark, monkeypatch):
    monkeypatch.setattr(passages, "MOST", 6)
    rng = random.Random(18)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    one, two = draw(22), draw(25)
    rows = [(n, " ".join(draw(70) + (one, two)[n % 2] + draw(70))) for n in range(60) if n not in (21, 44)]
    rows += [(n, " ".join(draw(70) + one + draw(4) + two + draw(70))) for n in (21, 44)]
    got = {(r.doc_id, r.source_id, r.words) for r in passages.repeated_passages(table(spark, rows)).collect()}
    assert got == {(44, 21, 47)}


def test_copies_of_a_text_are_joined_to_the_first_and_do_not_crowd_out_others(spark, monkeypatch):
    monkeypatch.setattr(passages, "MOST", 6)
    rng = random.Random(20)
    draw = lambda n: [f"w{rng.randrange(20_000)}" for _ in range(n)]
    passage = draw(60)
    copy = " ".join(draw(30) + passage + draw(30))
    rows = [(n, copy) for n in range(10, 30)] + [(n, " ".join(draw(40) + passage + draw(40))) for n in (5, 15_000, 25_000, 26_000)] + [(90, "a b"), (91, "a b")]
    got = sorted((r.doc_id, r.source_id, r.words) for r in passages.repeated_passages(table(spark, rows)).collect())
    apart = [5, 10, 15_000, 25_000, 26_000]
    assert got == sorted([(n, 10, 120) for n in range(11, 30)] + [(i, j, 60) for i in apart for j in apart if j < i])


def test_links_of_seeds_in_few_and_in_many_places(spark, monkeypatch):
    monkeypatch.setattr(passages, "MOST", 40)
    rng = random.Random(19)
    rows = [(seed, doc, 200 * seed + i) for seed in range(30) for i, doc in enumerate(rng.choices(range(9), k=rng.choice((2, 3, 12, 30))))]
    held = defaultdict(lambda: defaultdict(list))
    for seed, doc, at in rows:
        held[seed][doc].append(at)
    want = {(doc, src, at, min(docs[src])) for docs in held.values() for doc in docs for src in docs if src < doc for at in docs[doc]}
    rows += [(99, doc, 90_000) for doc in range(80)]
    want |= {(doc, src, 90_000, 90_000) for doc in range(80) for src in (0, doc - 1) if 0 <= src < doc}
    links, _ = passages.all_links_of(spark.createDataFrame(rows, "seed long, doc long, at int"), 3)
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("period", [1, 2, 7, 20, 23])
def test_a_text_that_repeats_itself_is_covered_whole(spark, period):
    rng = random.Random(period)
    word = lambda: f"w{rng.randrange(10**6)}"
    part = [word() for _ in range(period)]
    texts = [[word() for _ in range(90)] + (part * 700)[:n] + [word() for _ in range(90)] for n in (300, 600, 45)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    covered = defaultdict(set)
    for r in passages.repeated_passages(docs).collect():
        assert r.words >= 40 and r.words >= 0.8 * max(r.end - r.start, r.source_end - r.source_start)
        covered[r.doc_id] |= set(range(r.start, r.end))
    assert set(range(90, 690)) <= covered[1] and set(range(90, 135)) <= covered[2]


@pytest.mark.parametrize("period", [1, 3, 8, 20])
def test_places_left_out_have_others_near_that_see_the_same(period):
    rng = np.random.default_rng(period)
    text = np.concatenate([rng.integers(0, 2**40, 100), np.tile(rng.integers(0, 2**40, period), 900 // period), rng.integers(0, 2**40, 100)])
    words, offsets = np.concatenate([text, text]), np.array([0, len(text), 2 * len(text)])
    at = np.arange(2 * len(text) - 5)
    gone = passages.stands_again(words, offsets, at, 6, 40)
    assert gone.any() == (period < 20)  # of period 20 each stretch of 40 - 20 words has one place anyway
    kept = set(at[~gone].tolist())
    for a in at[gone].tolist():
        lo, hi = a - passages.FLANK, a + 6 + passages.FLANK
        near = [b for b in range(a - 39, a) if b in kept and (words[b - passages.FLANK : b + 6 + passages.FLANK] == words[lo:hi]).all()]
        assert near, a


def test_rows_that_add_no_word_are_left_out():
    columns = np.array([(0, 100, 0, 100), (0, 60, 0, 60), (50, 160, 200, 310), (90, 200, 50, 160), (110, 190, 70, 150)]).T
    assert sorted(passages.covering(*columns)) == [0, 2, 3]


def brute_chain(at, src, k, gap):
    best, order = [], sorted(range(len(at)), key=lambda i: at[i])
    for i in order:
        score = float(k)
        for j in best:
            if at[j[0]] < at[i] and src[j[0]] < src[i]:
                score = max(score, j[1] + min(k, at[i] - at[j[0]], src[i] - src[j[0]]) - gap * (at[i] - at[j[0]] + src[i] - src[j[0]]))
        best.append((i, score))
    return max(s for _, s in best)


def test_chains_are_collinear_and_near_the_best_score():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 30)
        at = np.array(sorted(rng.sample(range(100), n)))
        src = np.array([rng.randrange(100) for _ in range(n)])
        found = passages.chains_of(at, src, 6, 0.05)
        assert sorted(i for c in found for i in c.tolist()) == list(range(n))
        for c in found:
            assert (np.diff(at[c]) > 0).all() and (np.diff(src[c]) > 0).all()
        c = found[0]
        score = 6 + sum(min(6, at[b] - at[a], src[b] - src[a]) - 0.05 * (at[b] - at[a] + src[b] - src[a]) for a, b in zip(c, c[1:]))
        assert score <= brute_chain(at, src, 6, 0.05) + 1e-9 and score >= 0.75 * brute_chain(at, src, 6, 0.05)


# 1 and 7


def vectors(spark, rows, kind="float", clash=False):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.withColumns({c: F.lit(1) for c in ("score", "vector", "tree", "leaf", "codes", "query_id", "component_id", "asks", "block")}) if clash else df


def bad_rows(width=16):
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [0.0] * width, 1), (9003, [nan] + [1.0] * (width - 1), 1), (9004, [inf] * width, 1), (9005, [None] + [1.0] * (width - 1), 1), (9006, [], 1), (None, [1.0] * width, 1), (9007, [1.0] * width, None), (9008, [1.0] * (width + 3), 1)]


def cloud(n, seed, width=16):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, width))
    rows[n // 2 : n // 2 + n // 5] = rows[0] + 0.02 * rng.standard_normal((n // 5, width))
    rows[-n // 10 :] = rows[1]
    return rows.astype(np.float32).astype(float)


@pytest.mark.parametrize("clash", [False, True])
def test_nearest_against_brute_force(spark, clash):
    x = cloud(400, 1)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + bad_rows()
    got = defaultdict(list)
    for r in ann.nearest(vectors(spark, rows, clash=clash), F.col("vec_id") % 50 == 0, k=5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    every = np.vstack([x, np.ones((1, 16))])
    ids = [*range(400), 9007]
    unit = every / np.linalg.norm(every, axis=1)[:, None]
    for q in range(0, 400, 50):
        cos = unit @ unit[q]
        order = sorted((i for i in range(len(ids)) if i != q), key=lambda i: (-round(cos[i], 12), ids[i]))[:5]
        assert [(r, v) for r, v, _ in sorted(got[q])] == [(k + 1, ids[i]) for k, i in enumerate(order)]
        assert all(abs(s - cos[ids.index(v)]) < 1e-12 for _, v, s in got[q])
    assert set(got) == set(range(0, 400, 50))


def test_nearest_recall_where_not_all_is_inspected(spark):
    x = np.random.default_rng(3).standard_normal((3000, 16))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    found = ann.nearest(vectors(spark, rows, "double"), F.col("vec_id") % 50 == 0, k=5, leaf_rows=60, share=1.5).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 3000, 50):
        cos = unit @ unit[q]
        cos[q] = -2
        hits += len(set(np.argsort(-cos)[:5].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert hits / 300 >= 0.9


def test_repeated_rows_and_ids_are_one_neighbour(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((60, 8))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] * 3 + [(7, (-x[7]).tolist(), 0), (8, x[9].tolist(), 0)] + [(200 + i, v.tolist(), 0) for i, v in enumerate(rng.standard_normal((9, 5)))]
    found = ann.nearest(vectors(spark, rows, "double"), F.col("vec_id") % 50 == 0, k=5, leaf_rows=10, share=100.0).collect()
    held = defaultdict(list)
    for i, v, _ in rows:
        held[i].append(np.array(v) / np.linalg.norm(v))
    for q in (0, 50, 200):
        best = {i: max(v @ held[q][0] for v in vs) for i, vs in held.items() if i != q and len(vs[0]) == len(held[q][0])}
        want = sorted(best, key=lambda i: (-round(best[i], 12), i))[:5]
        assert [v for _, v in sorted((r["rank"], r.vec_id) for r in found if r.query_id == q)] == want


def recall(spark, folder, every=1):
    """Of the query's neighbours of its vectors (each `every`-th of them), how many are among the nearest by brute force."""
    from spanlake.llm import queries

    found = defaultdict(set)
    for r in queries.op1_nearest(spark, folder).collect():
        found[r.query_id].add(r.vec_id)
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect() if r.embedding and None not in r.embedding}
    rows = {i: v for i, v in rows.items() if np.isfinite(v).all() and v.any()}
    ids, unit = np.array(list(rows)), np.array([v / np.linalg.norm(v) for v in rows.values()])
    hits, asked = 0, [i for i in rows if i % 50 == 0][::every]
    for q in asked:
        near = unit @ unit[np.flatnonzero(ids == q)[0]]
        near[ids == q] = -2
        hits += min(5, len(found[q] & set(ids[near >= np.sort(near)[-5] - 1e-9].tolist())))
    return hits / (5 * len(asked))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query_on_the_given_tables(spark, folder):
    assert recall(spark, folder) >= 0.9


def test_nearest_with_few_candidates(spark):
    one = vectors(spark, [(0, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (7, [1.0, 1.0], 0)])
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(one, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert ann.nearest(one.limit(0), F.lit(True)).count() == 0 and ann.nearest(vectors(spark, bad_rows()[:4]), F.lit(True)).count() == 0


@pytest.mark.parametrize("block", [16, 1024])
def test_near_vectors_against_brute_force(spark, block):
    x = cloud(300, 2)
    rows = [(i, v.tolist(), i % 2 if i % 11 else None) for i, v in enumerate(x)] + bad_rows() + [(3, x[3].tolist(), 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_duplicates(vectors(spark, rows, clash=True), block_rows=block).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    union, links = Union(), defaultdict(int)
    labels = [i % 2 if i % 11 else None for i in range(300)]
    extra = defaultdict(int, {3: 1})
    for a in range(300):
        for b in range(a):
            if labels[a] is not None and labels[a] == labels[b] and unit[a] @ unit[b] >= 0.93:
                links[a] += 1 + extra[b]
                links[b] += 1 + extra[a]
                union.join(a, b)
    for i in range(300):
        if i != 3:
            assert got[i] == (links[i], union.find(i), union.find(i) == i), i
    assert all(got[i][0] == 0 and got[i][2] for i in (9001, 9002, 9003, 9004, 9005, 9006, 9007)) and got[None] == (0, None, True)


def test_near_vectors_that_share_only_a_probe_are_linked_once(spark):
    x = cloud(400, 5)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    codes = near_vectors.hashes(unit.astype(np.float32).astype(float), 1, 2, 3, 11)[:, 0]
    want, probed = defaultdict(int), 0
    for a in range(400):
        for b in range(a):
            if unit[a] @ unit[b] >= 0.6 and set(codes[a]) & set(codes[b]):
                probed += codes[a][0] not in codes[b] and codes[b][0] not in codes[a]
                want[a] += 1
                want[b] += 1
    got = {r.vec_id: r.n_links for r in near_vectors.near_duplicates(vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)]), threshold=0.6, tables=1, block_rows=32).collect()}
    assert probed and got == {i: want[i] for i in range(400)}


def test_near_vectors_of_an_empty_table(spark):
    assert near_vectors.near_duplicates(vectors(spark, []).limit(0)).count() == 0


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(np.linalg.norm(near_vectors.hadamard(x), axis=1), np.linalg.norm(x, axis=1)) and np.allclose(near_vectors.hadamard(near_vectors.hadamard(x)), x)
