"""Small tables with every awkward case."""

import random

from pyspark.sql import functions as F

CLASHING = ("row", "length", "token", "rep", "text_hash", "doc", "component_id", "n_lines", "n_deleted", "severity", "grade", "toxic", "n_email", "vector", "codes", "head", "ids", "salt", "rank", "tree", "leaf", "start", "n_tokens")


def awkward_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, long = text(60), text(30_000)
    near = base.split()
    near[30] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "one"), (9, "one two"), (10, long), (11, long + " tail"),
        (12, "é İ ß 日本 ｆ  x"), (13, base.upper()), (14, "a\nb\nc\nd"), (15, "z\na\nb\nq\na\nb"), (16, "a\nb"), (None, base), (None, None), (17, "dup"), (17, "dup"), (18, "x" * 5000), (19, "   lead"),
    ]


def table(spark, rows=None, clash=False):
    rows = awkward_rows() if rows is None else rows
    docs = spark.createDataFrame([(i, t, None, "src0", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(1) for c in CLASHING}) if clash else docs


def empty(spark):
    return table(spark).limit(0)
