"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two first-order models over characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a long token whose
mean log-likelihood ratio per character pair exceeds ``MARGIN`` is a secret.
The labelled samples come from a bounded number of documents taken by hash
(``SAMPLE_DOCS``): the short tokens of their whole texts, their words joined as
identifiers, paths and assignments are (``SHAPES``), dates, numbers and rules of
separators are ordinary; digests of their ids in hex, base64 and base36 are
random.  The counts behind both models are one aggregate of at most
2 * 128 * 128 rows.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions

#: Documents that the two models are trained on, at most about this many.
SAMPLE_DOCS = 2_000
#: Random strings, and of each kind numbers and dates, made of each sampled document's id.
STRINGS = 4
#: Least length of a token that the models judge, and least mean ratio (nats) of a secret.
LEAST, MARGIN = 20, 0.5
TOKEN = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Characters of a token; both models are smoothed over them.
ALPHABET = 67
SEPARATORS = "-_=/+"

# The patterns of the base kinds, in their order.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the maximal runs of 32 or more, as of [0-9a-f]+ those that are long enough
KINDS = ["assign", "access", "hex", "random"]


SPANS = "array<struct<start:int,rank:int,end:int>>"


def with_spans(rows: DataFrame, name: str, pattern: str, rank: int, worth: Column, good) -> DataFrame:
    """Adds ``name``: (start, rank, end) in code points of the leftmost non-overlapping matches for which ``good(match)`` holds.

    The text between the matches and the matches alternate, so their lengths
    add up to the places.  Only texts for which ``worth`` holds are searched.
    Both are columns of their own before the places are added up: inside the
    loop the pattern would be applied again for every match.
    """
    rows = rows.withColumns({"_gaps": F.when(worth, F.split("text", pattern, -1)), "_hits": F.when(worth, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))})
    empty = F.array().cast(SPANS)

    def step(acc: Column, i: Column) -> Column:
        hit = F.get("_hits", i)
        start = acc["at"] + F.length(F.get("_gaps", i))
        end = start + F.length(hit)
        return F.struct(end.alias("at"), F.when(good(hit), F.concat(acc["found"], F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))))).otherwise(acc["found"]).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    places = F.aggregate(F.sequence(F.lit(0), F.size("_hits") - 1), begin, step, lambda acc: acc["found"])
    return rows.withColumn(name, F.when(F.size("_hits") > 0, places).otherwise(empty)).drop("_gaps", "_hits")


def with_base(rows: DataFrame) -> DataFrame:
    """Adds ``base``, the spans of the fixed patterns by start and then kind; texts without their letters are not searched."""
    low = F.lower("text")
    may_assign = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    rows = with_spans(rows, "_assign", ASSIGN, 0, may_assign, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 8)
    rows = with_spans(rows, "_access", ACCESS, 1, F.col("text").contains("AKIA"), lambda hit: F.length(hit) >= 16)
    rows = with_spans(rows, "_hex", HEX, 2, F.col("text").rlike(HEX), lambda hit: F.lit(True))
    return rows.withColumn("base", F.array_sort(F.concat("_assign", "_access", "_hex"))).drop("_assign", "_access", "_hex")


def number(i: Column, digits: int) -> Column:
    """The i-th number of a document as so many digits."""
    return F.lpad(F.pmod(F.xxhash64("doc_id", F.lit("number"), i), F.lit(10**digits)).cast("string"), digits, "0")


def day(i: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(F.xxhash64("doc_id", F.lit("day"), i), F.lit(25_000)).cast("int")).cast("string")


def shaped(words: Column, i: Column) -> Column:
    """Words joined as in code, file names and links, in the shape whose turn it is."""
    low, names = F.transform(words, F.lower), F.transform(words, F.initcap)
    shapes = [
        F.array_join(low, "_"), F.array_join(low, "-"), F.upper(F.array_join(low, "_")), F.array_join(names, ""),
        F.concat(F.get(low, 0), F.array_join(F.slice(names, 2, 2), "")), F.concat(F.lit("/"), F.array_join(low, "/")),
        F.concat(F.get(low, 0), number(i, 1), F.lit("/"), F.array_join(F.slice(low, 2, 2), "-")), F.concat(F.array_join(F.slice(low, 1, 2), "_"), F.lit("_"), number(i, 4)),
        F.concat(F.get(low, 0), F.lit("/"), F.translate(day(i), "-", "/"), F.lit("/"), F.get(low, 1)), F.concat(F.array_join(F.slice(low, 1, 2), "="), F.lit("-"), number(i, 2)),
    ]
    turn = F.pmod(i, F.lit(len(shapes)))
    out = F.when(turn == 0, shapes[0])
    for k, shape in enumerate(shapes[1:], 1):
        out = out.when(turn == k, shape)
    return out


def samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``random, token``: labelled strings from about ``sample_docs`` documents."""
    total = docs.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("secret sample")), F.lit(1 << 30))
    some = docs.where(F.col("doc_id").isNotNull() & (draw < int((1 << 30) * min(1.0, sample_docs / max(total, 1))))).limit(2 * sample_docs).repartition(partitions(docs.sparkSession))
    some = some.withColumns({"short": F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_=-]+"), F.lit(0)), lambda x: F.length(x) < LEAST),
                             "words": F.regexp_extract_all("text", F.lit(r"\b([A-Za-z]{3,})\b"), F.lit(1))})
    threes = F.transform(F.sequence(F.lit(0), F.floor(F.size("words") / 3).cast("int") - 1), lambda i: shaped(F.slice("words", 3 * i + 1, F.lit(3)), i))
    joined = F.when(F.size("words") >= 3, threes).otherwise(F.array().cast("array<string>"))
    numbers = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(STRINGS)), lambda i: F.array(number(i, 18), F.concat(day(i), number(i, 15)), F.concat(F.translate(day(i), "-", ""), number(i, 12)))))
    rules = F.array(*[F.lit(c * 2 * LEAST) for c in SEPARATORS])
    ordinary = some.select(F.lit(False).alias("random"), F.explode(F.concat("short", joined, numbers, rules)).alias("token"))
    digest = lambda i: F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), i.cast("string")), 256)
    made = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(STRINGS)), lambda i: F.array(
        F.substring(digest(i), 1, 40), F.rtrim(F.base64(F.unhex(digest(i))), F.lit("=")),
        F.concat(*[F.conv(F.substring(digest(i), k, 12), 16, 36) for k in (1, 13, 25)]))))
    return ordinary.unionByName(some.select(F.lit(True).alias("random"), F.explode(made).alias("token")))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters, random over ordinary (add-one estimates)."""
    pairs = labelled.where(F.length("token") > 1).select("random", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"))
    counts = (pairs.select("random", F.ascii(F.substring("token", F.col("i"), F.lit(1))).alias("a"), F.ascii(F.substring("token", F.col("i") + 1, F.lit(1))).alias("b"))
              .where((F.col("a") < 128) & (F.col("b") < 128)).groupBy("random", "a", "b").count().collect())
    if len({r["random"] for r in counts}) < 2:
        return [0.0] * (128 * 128)
    n = {(r["random"], r["a"], r["b"]): r["count"] for r in counts}
    row: dict[tuple[bool, int], int] = {}
    for (kind, a, _), c in n.items():
        row[kind, a] = row.get((kind, a), 0) + c

    def log_p(kind: bool, a: int, b: int) -> float:
        return math.log((n.get((kind, a, b), 0) + 1) / (row.get((kind, a), 0) + ALPHABET))

    return [log_p(True, a, b) - log_p(False, a, b) for a in range(128) for b in range(128)]


def ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's character pairs under the table of ``train``."""
    values = F.split(F.lit(",".join(f"{v:.6f}" for v in table)), ",").cast("array<double>")  # one constant
    at = lambda i: F.ascii(F.substring(token, i, F.lit(1)))
    total = F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda acc, i: acc + F.get(values, at(i) * 128 + at(i + 1)))
    return total / (F.length(token) - 1)


def scan(docs: DataFrame, table: list[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: the spans of the fixed patterns, and these with the random-looking tokens.

    Spans are (start, rank of the kind, end) in code points; a token that
    touches a span of a fixed pattern adds none.  Null texts are empty; a null
    id is scanned, not trained on; repeated rows each give a row; an empty
    table trains nothing and gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    table = train(samples(slim)) if table is None else table
    added = with_spans(with_base(slim), "random", TOKEN, 3, F.col("text").rlike(TOKEN), lambda hit: ratio(hit, table) > MARGIN)
    apart = F.filter("random", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return added.select("doc_id", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def shown(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))))


def summary(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """One row per document: counts of the fixed kinds, their digest, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda x: x["rank"] == k)).cast("long")
    return scan(docs, table).select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                                    F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
