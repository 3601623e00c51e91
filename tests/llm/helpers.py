"""Small inputs with every awkward row, and plain-Python references."""

import re

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

# Columns that could clash with the operators' own names.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("words", T.StringType()), T.StructField("component", T.StringType()), T.StructField("line", T.StringType())])


def sentence(seed: int, n: int) -> str:
    """n words of a fixed pseudo-random sequence."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"{WORDS[(x >> 16) % len(WORDS)]}{(x >> 8) % 50}")
    return " ".join(out)


def awkward():
    """(doc_id, text): nulls, empties, blanks, repeated rows, copies, a null id, one long text, no spaces."""
    base = sentence(1, 120)
    near = base.replace(base.split()[60], "changed")
    return [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (5, base), (6, near), (None, base), (None, None),
            (7, "one"), (8, "one two"), (9, "x" * 3000), (10, sentence(2, 20_000)), (11, "Ünïcödé ßtraße 你好 🤖 \x00 end"),
            (12, "\n".join([sentence(3, 12)] * 4)), (13, sentence(3, 12)), (14, "...,;!"), (15, sentence(4, 9))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "k", 1, "s", "w", "c", "l") for i, t in rows], SCHEMA)


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)
