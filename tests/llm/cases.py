"""Documents with every hard case: nulls, empty and long texts, repeated rows, ties, extra columns."""

from pyspark.sql import types as T

L, S = T.LongType(), T.StringType()
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L),
    # columns whose names the operators use themselves
    ("block", S), ("part", S), ("print", S), ("id", S), ("line", S), ("_place", S), ("words", S), ("node", S))])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


TEXTS = [
    (1, prose(1, 80)), (2, prose(2, 80)), (3, prose(1, 80)),  # 3 copies 1
    (4, prose(1, 80).replace("alpha", "ALPHA", 1)), (5, None), (6, ""), (7, " \t\n "), (8, "word"),
    (9, "é ñ 日本語 " + prose(9, 40) + "\n" + prose(2, 80)), (10, "!!! ### 123"), (11, prose(11, 3000)),
    (11, prose(11, 3000)), (12, "one two three four"), (12, "another row of the same id"), (None, prose(2, 80)), (None, None),
    (13, "x" * 5000), (14, prose(14, 30) + "\n" + prose(14, 30) + "\n\n" + prose(1, 20)), (-5, prose(5, 60)),
]


def documents(spark, texts=None):
    rows = [(i, t, None if k % 7 == 3 else "en" if k % 2 else "de", None if k % 5 == 4 else f"s{k % 3}", len(t or ""), "b", "p", "x", "i", "l", "q", "w", "n")
            for k, (i, t) in enumerate(TEXTS if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
