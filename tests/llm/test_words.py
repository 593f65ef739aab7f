"""Spelling variants, fill-in-the-middle and language identification, against brute force, SQL and held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from fixtures import empty, table
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import fill_middle, language_id, queries, spelling

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    mine = queries.QUERIES[name](spark, SF)
    theirs = con.execute(queries.ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert set(names) == set(mine.columns)
    assert Counter(tuple(r) for r in mine.select(names).collect()) == Counter(theirs.fetchall())


# spelling variants


def brute_variants(rows, letters=7, count=2, times=10, every=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= letters:
                n[word] += 1
    n = {w: c for w, c in n.items() if c >= count}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
            shorter = w[:k] + w[k + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= times * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items()}


def spelled_rows():
    """Few letters, so words are near each other in every way; forms of forms; long runs; letters beyond the range; repeated rows."""
    rng, rows = random.Random(11), []
    for i in range(60):
        words = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))) for _ in range(40)]
        rows.append((i, " ".join(rng.choice(words) for _ in range(120)).capitalize()))
    chain = " ".join(["wonderful"] * 200 + ["wonderfull"] * 20 + ["wonderfulll"] * 2 + ["vonderfull"] * 2)
    rows += [(100, chain), (101, "z" * 3000 + " " + "z" * 2999 + " " + "y" * 70), (101, "z" * 3000 + " " + "z" * 2999 + " " + "y" * 70), (102, "日本alphabetĀalphabet1alphabet"), (None, "alphabet alphabets"), (None, None), (103, ""), (104, "alphabets")]
    return rows


def test_variants_equal_brute_force(spark):
    rows = spelled_rows()
    for clash in (False, True):
        got = spelling.spelling_variants(table(spark, rows, clash))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in got.collect()} == brute_variants(rows)
    want = brute_variants(rows)
    assert any(f and r != f for _, f, r, *_ in want), "forms of forms"
    assert any(n > 4 for *_, n, _ in want)


def test_variants_with_a_growing_dictionary(spark, monkeypatch):
    """A low limit makes most grams frequent, so words are cut into long grams and many have a bound that covers them all."""
    monkeypatch.setattr(spelling.gram_dictionary, "__defaults__", (2, 7, 3, 65_536))
    rows = spelled_rows()
    assert {tuple(r) for r in spelling.spelling_variants(table(spark, rows)).collect()} == brute_variants(rows)


def test_variants_without_words(spark):
    assert spelling.spelling_variants(empty(spark)).count() == 0
    assert spelling.spelling_variants(table(spark, [(1, None), (2, ""), (3, "one two")])).count() == 0


def test_variants_equal_sql(spark):
    same_as_sql(spark, "op11_spelling")


ALPHABET = "abcdeé"


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET, min_size=2, max_size=14), st.integers(0, 14), st.sampled_from(ALPHABET), st.sampled_from(["insert", "delete", "replace"]), st.integers(0, 40), st.randoms())
def test_an_edit_changes_no_more_grams_than_the_bound(word, at, letter, kind, limit, rng):
    at = min(at, len(word) - 1)
    other = {"insert": word[:at] + letter + word[at:], "delete": word[:at] + word[at + 1 :], "replace": word[:at] + letter + word[at + 1 :]}[kind]
    words = [word, other, *("".join(rng.choice(ALPHABET) for _ in range(9)) for _ in range(40))]
    points = lambda w: np.array([[ord(c) for c in w]], np.uint32)
    counts = Counter()
    for w in words:
        classes = spelling.letter_classes(points(w)) if w else None
        for q in range(2, min(7, len(w) + 1)):
            counts.update(spelling._gram_codes(classes, q)[0].tolist())
    d = spelling.GramDictionary.of({c: n for c, n in counts.items() if n > limit})

    def grams(w):
        if len(w) < 2:
            return set(), 0
        _, begin, end, number, _, bound = d.cut(points(w))
        return set(zip(begin.tolist(), end.tolist(), number.tolist())), int(bound[0])

    (mine, bound), (theirs, _) = grams(word), grams(other)
    before = {(word[:e], b, x) for b, e, x in mine} & {(other[:e], b, x) for b, e, x in theirs}
    after = {(word[b:], x) for b, e, x in mine} & {(other[b:], x) for b, e, x in theirs}
    shared = sum((word[:e], b, x) in before or (word[b:], x) in after for b, e, x in mine)
    assert shared >= len(mine) - bound


def test_checksums_of_runs():
    text = "Ab é" + "x" * 300 + " ÀÖ×÷ÿ Āq"
    data, start, end, points, doc = spelling.letter_runs(__import__("pyarrow").array([None, text, "", text]), 1)
    runs = [data[a:b].tobytes().decode() for a, b in zip(start, end)]
    assert runs == ["ab", "é" + "x" * 300, "ÀÖ×÷ÿ", "q"] * 2 and doc.tolist() == [1] * 4 + [3] * 4 and points.tolist() == [2, 301, 5, 1] * 2
    seeds = np.array([zlib.crc32(b"7:")] * 8, np.uint32)
    assert spelling.run_checksums(data, start, end, seeds).tolist() == [zlib.crc32(f"7:{r}".encode()) for r in runs]


# fill in the middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_middles_equal_sql(spark):
    same_as_sql(spark, "op12_fill_middle")


@settings(max_examples=300, deadline=None)
@given(st.text("ab \t\n\x0b\x0c\r\x85\xa0é日😀<PSM>", max_size=80), st.integers(0, 400))
def test_cuts_and_round_trip(text, doc_id):
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, form, prefix, middle, output = fill_middle.transform(text, str(doc_id))
    digest = sha(f"42:{doc_id}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    marked = any(m in text for m in ("<P>", "<S>", "<M>"))
    assert n == len(units) and fill_middle.restored(output, form) == text
    assert form == ("plain" if not text or marked or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm")
    if form == "plain":
        assert output == text and prefix is middle is None
    else:
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        assert output == (f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}") and (prefix, middle) == (len(p), len(m))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 12), st.integers(1, 100_000)), min_size=0, max_size=3000), st.sampled_from([1, 8, 64, 127, 300]))
def test_rank_index_is_exact_and_its_error_is_bounded(steps, error):
    offsets = np.concatenate([[0], np.cumsum(np.array(steps, np.int64))]).astype(np.int64)
    index = fill_middle.RankIndex.fit(offsets, error)
    ranks = np.arange(len(offsets))
    assert (index.offset(ranks) == offsets).all()
    assert np.abs(offsets - index.predicted(ranks)).max() <= error
    assert index.residual.dtype == (np.int8 if error <= 127 else np.int16)


def test_middles_of_awkward_rows(spark):
    out = fill_middle.fill_in_middle(table(spark, clash=True).withColumnRenamed("length", "output"))
    assert out.columns[-5:] == ["n", "form", "prefix_chars", "middle_chars", "__output"]
    rows = out.collect()
    assert len(rows) == table(spark).count()
    for r in rows:
        want = fill_middle.transform(r["text"] or "", "" if r["doc_id"] is None else str(r["doc_id"]))
        assert tuple(r[-5:]) == want
    digests = fill_middle.digests(table(spark)).collect()
    assert all(d["restored_sha256"] in {sha(r["text"] or "") for r in rows} for d in digests)
    assert fill_middle.digests(empty(spark)).count() == 0
    words = " ".join(f"w{i}" for i in range(200_000))
    assert fill_middle.transform(words, "7")[0] == 200_000


# language


def sets_of(text, spectrum=4):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    letters = re.sub(" +", " ", letters)
    return {letters[i : i + n] for n in range(1, spectrum + 1) for i in range(len(letters) - n + 1)}


def test_kernel_counts_shared_grams():
    texts = ["Der Hund, die Katze!", "the dog and the cat 12", "日本語 text \U00010400x", "a", "x1y--z"]
    model = language_id.landmark_model(["de", "en"], texts[:3])
    marks = [sets_of(t) for t in texts[:3]]
    all_ = set().union(*marks)
    want = [[len(sets_of(t) & m) / np.sqrt(max(1, len(sets_of(t) & all_)) * len(m)) for m in marks] for t in texts]
    assert np.allclose(model.kernel(texts), want)
    assert len(all_) == model.presence.shape[0]


def test_ridge_equals_the_full_solution():
    """With every row a landmark the Nystroem map loses nothing: the same values as kernel ridge regression solved at once."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd " if i % 2 else "cdef ") for _ in range(60)) + "q" for i in range(20)]
    language = np.array([i % 2 for i in range(20)])
    model = language_id.landmark_model(["x", "y"], texts)
    among = model.kernel(texts)
    got = among @ language_id.fit_ridge(model, among, among, language, 1e-2)
    target = np.where(language[:, None] == np.arange(2), 1.0, -1.0)
    want = among @ np.linalg.solve(among + 1e-2 * 20 * np.eye(20), target)
    assert np.allclose(got, want, atol=1e-6)


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op13_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = got.collect()
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    for r in language_id.accuracy(got, docs).collect():
        assert r["right"] >= 0.98 * r["rows"]
    # The rows held out have no part in the fit.
    hidden = docs.withColumn("lang", __import__("pyspark").sql.functions.when(~language_id.held_out(), docs["lang"]))
    assert sorted(map(tuple, language_id.identified(hidden).collect())) == sorted(map(tuple, rows))


def test_languages_of_awkward_rows(spark):
    docs = table(spark, clash=True).withColumnRenamed("rank", "score")
    assert all(r["lang_pred"] == "und" and r["__score"] == 0 for r in language_id.predict(docs, language_id.fit(docs)).collect()), "no row has a language"
    rows = [(1, "der hund und die katze " * 9), (2, "the dog and the cat " * 9), (3, None), (4, ""), (5, "12 !"), (6, "the dog"), (6, "the dog"), (None, "die katze"), (7, "²½")]
    docs = table(spark, rows).replace({"src0": "x"}).drop("lang").selectExpr("*", "CASE WHEN text LIKE '%die katze %' THEN 'de' WHEN text LIKE '%the cat %' THEN 'en' WHEN doc_id = 5 THEN 'xx' END AS lang")
    said = {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert said == {(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (None, "de"), (7, "und")}
    assert language_id.identified(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        language_id.fit(spark.range(300).selectExpr("CAST(id AS STRING) AS lang", "'abc' AS text"))
