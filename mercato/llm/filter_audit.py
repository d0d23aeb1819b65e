"""Filter interaction audit: what each filter removes in every order in which the filters can be applied.

Five filters with a bit each: few words (A), few distinct words (B), many
capitals (C), markup symbols (D), and a text that a smaller id has as well
(E).  The first four are functions of a row.  E is an existential self-join:
the documents left-semi joined with themselves on the text's hash, the exact
text and a smaller id.  Its right side is reduced to the smallest id of each
text that occurs twice, by an aggregate that combines before it is shuffled,
and a text of very many copies is dealt to as many parts as its number of rows
asks for.  The ids it finds are united with the rows that carry the other failures;
one aggregate gives each document's combination of bits, another the number of
documents of each combination.  All orders are then read off those at most 32
counts a part, so no order costs a pass over the documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions, words_of
from mercato.plans.lineage import materialize
from mercato.plans.ranges import MAX_LOOKUP_ROWS, attach_lookup

FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SYMBOLS = "[#$%&*|]"


def keyed(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id, part, text, h, g``: null texts and parts are empty; ``h`` and ``g`` are two hashes of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    return rows.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")})


def own_failures(rows: DataFrame) -> DataFrame:
    """``doc_id, part, h, g, bits, docs``: a row for every document, with the bits of A to D."""
    words = words_of(F.col("text"))
    figures = rows.select(
        "doc_id", "part", "h", "g", F.length("text").alias("n_chars"), F.size(words).alias("n_words"), F.size(F.array_distinct(words)).alias("n_distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_capitals"), F.col("text").rlike(SYMBOLS).alias("marked"))
    failed = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": F.col("n_distinct").cast("long") * 100 < F.col("n_words").cast("long") * LEAST_DISTINCT,
        "C": F.col("n_capitals").cast("long") * 100 > F.col("n_chars").cast("long") * MOST_CAPITALS,
        "D": F.col("marked"),
    }
    bits = sum((F.when(c, F.lit(BIT[f])).otherwise(F.lit(0)) for f, c in failed.items()), F.lit(0))
    return figures.select("doc_id", "part", "h", "g", bits.alias("bits"), F.lit(1).cast("long").alias("docs"))


def copies_of_smaller(rows: DataFrame, part_rows: int | None = None) -> DataFrame:
    """``doc_id, part, h, g`` of the rows whose text some smaller id has, too.  A null id is neither smaller nor larger than another.

    Rows of a hash with more than ``part_rows`` rows (by default a task's fair
    share of all rows, so there are fewer such hashes than tasks) are dealt to
    several parts, and their smallest ids go to each of them.
    """
    tasks = partitions(rows.sparkSession)
    share = part_rows or max(1, rows.count() // tasks)
    hot = (rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
           .select("h", F.ceil(F.col("n") / share).cast("int").alias("cuts")))
    hot = materialize(hot)

    def with_cuts(df: DataFrame, salt_by: str) -> DataFrame:
        return attach_lookup(df, hot, ["h"], F.col(salt_by), max_rows=max(MAX_LOOKUP_ROWS, tasks)).withColumn("cuts", F.coalesce("cuts", F.lit(1)))

    smallest = rows.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("first").isNotNull())
    smallest = with_cuts(smallest, "first").select(
        F.col("h").alias("w_h"), F.col("text").alias("w_text"), F.col("first").alias("w_id"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("w_salt"))
    dealt = with_cuts(rows, "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int"))
    same = (dealt["h"] == smallest["w_h"]) & (dealt["salt"] == smallest["w_salt"]) & (dealt["text"] == smallest["w_text"])
    return dealt.join(smallest, same & (smallest["w_id"] < dealt["doc_id"]), "left_semi").select("doc_id", "part", "h", "g")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", part_rows: int | None = None) -> DataFrame:
    """``doc_id, part, h, g, bits, docs``: the combination of failed filters of each distinct row, and how often the row occurs."""
    rows = keyed(docs, id_col, text_col, part_col)
    marked = copies_of_smaller(rows, part_rows).select("*", F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("long").alias("docs"))
    united = own_failures(rows).unionByName(marked)
    return united.groupBy("doc_id", "part", "h", "g").agg(F.bit_or("bits").alias("bits"), F.sum("docs").alias("docs"))


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, good, toxic, docs``: documents of each combination and label.

    A document is good (toxic) if any row of ``labels`` with its id says so;
    null labels say nothing, ids without a label are neither.
    """
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    # written first, so that a join with very many rows of one id (or of none) can be split
    told = materialize(labels.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(yes("quality").alias("good"), yes("toxic").alias("toxic")))
    joined = failed.join(told, failed["doc_id"] == told["l_id"], "left")
    of = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    return joined.groupBy("part", "bits", *of).agg(F.sum("docs").alias("docs"))


def with_steps(rows: DataFrame) -> DataFrame:
    """Each row once for every step of every order: ``filter_order, step``, its filter's bit (``own``) and the bits of those ``before``."""
    orders = F.split(F.lit(",".join("".join(o) for o in permutations(FILTERS))), ",")
    bit = lambda k: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring("filter_order", k, F.lit(1))) - 1)
    dealt = rows.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    before = sum((F.when(F.col("step") > k, bit(F.lit(k))).otherwise(F.lit(0)) for k in range(1, len(FILTERS))), F.lit(0))
    return dealt.withColumns({"own": bit(F.col("step")), "before": before})


def interactions(counted: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counts of the combinations."""
    rows = with_steps(counted)
    fails, gone = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda c, n=F.col("docs"): F.sum(F.when(c, n).otherwise(F.lit(0))).cast("long")
    # of all orders the filter comes first among the k that a document fails in one of k
    first = F.col("docs") * F.lit(factorial(len(FILTERS))) / F.bit_count("bits")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"), total(fails, first.cast("long")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, filter_order, step`` and the counts of documents for each of the 120 orders' five steps in every part.

    Null and empty texts are one text, null and empty parts one part.  Rows
    with the same id count each; they are not copies of one another (an id is
    not smaller than itself).  A null id is no copy and makes none, and has no
    labels.  An empty table has no parts and gives no rows.  Extra columns are
    not looked at.
    """
    return interactions(combinations(failures(docs, id_col, text_col, part_col), labels))


def oracle_sql() -> str:
    order = ", ".join(f"'{''.join(o)}'" for o in permutations(FILTERS))
    words = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"
    return f"""
with docs as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
figures as (
  select doc_id, part, text, len({words}) as n_words, len(list_distinct({words})) as n_distinct, length(text) as n_chars,
         len(regexp_extract_all(text, '[A-Z]')) as n_capitals, regexp_matches(text, '{SYMBOLS}') as marked
  from docs),
firsts as (select text, min(doc_id) as first_id from docs group by text),
told as (select doc_id, max(coalesce(quality = 1, false)::int) as good, max(coalesce(toxic = 1, false)::int) as toxic from labels group by doc_id),
bits as (
  select f.part, coalesce(t.good, 0) as good, coalesce(t.toxic, 0) as toxic,
         (n_words < {LEAST_WORDS})::int + 2 * (100 * n_distinct < {LEAST_DISTINCT} * n_words)::int + 4 * (100 * n_capitals > {MOST_CAPITALS} * n_chars)::int
         + 8 * marked::int + 16 * coalesce(f.doc_id > s.first_id, false)::int as bits
  from figures f join firsts s on f.text = s.text left join told t on f.doc_id = t.doc_id),
counted as (select part, bits, good, toxic, count(*) as docs from bits group by all),
orders as (select unnest([{order}]) as filter_order),
steps as (
  select filter_order, step, (1 << (strpos('{FILTERS}', substr(filter_order, step::int, 1)) - 1)) as own,
         coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (strpos('{FILTERS}', substr(filter_order, i::int, 1)) - 1))), 0)::int as before
  from orders, range(1, 6) r(step))
select part, filter_order, step::int as step,
       sum(case when bits & own = 0 and bits & before = 0 then docs else 0 end)::bigint as kept,
       sum(case when bits & own <> 0 and bits & before = 0 then docs else 0 end)::bigint as removed,
       sum(case when bits & own <> 0 and bits & before <> 0 then docs else 0 end)::bigint as redundant,
       sum(case when bits = own then docs else 0 end)::bigint as unique_fails,
       sum(case when bits & own <> 0 and bits & before = 0 then docs * good else 0 end)::bigint as good_lost,
       sum(case when bits & own <> 0 and bits & before = 0 then docs * toxic else 0 end)::bigint as toxic_lost,
       sum(case when bits & own <> 0 then docs * 120 // bit_count(bits::int) else 0 end)::bigint as shapley
from counted, steps group by part, filter_order, step
"""
