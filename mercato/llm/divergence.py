"""Quality rules by distribution divergence.

For each language a reference is gathered from all of its documents: the
shares of the character classes, and of its ``COMMON`` most frequent words
among all words.  A document's own two histograms are compared with its
language's by the Jensen-Shannon distance (square root of the divergence to
base 2, so from 0 to 1).  A text below ``LEAST_CHARS`` or ``LEAST_WORDS`` has
too few of either for its distance to mean anything and is not judged by it.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import SPACES, words_of
from mercato.plans.ranges import attach_lookup

#: Most frequent words of a language that a histogram counts.
COMMON = 24
LEAST_CHARS, LEAST_WORDS = 200, 50
#: Bits that the place of a window takes in the sorted longs.
PLACE_BITS = 24
#: Largest distances of a kept document.
MOST_CLASS, MOST_WORD = 0.30, 0.45

# The character classes, each counted among what those before it leave.
CLASSES = [("lower", "[a-z]+"), ("space", "[\\x20\\x09-\\x0D]+"), ("upper", "[A-Z]+"), ("letter", "\\p{L}+"), ("digit", "[0-9]+"), ("stop", "[.,;:!?'\"()-]+")]
SYMBOLS = "[#*$%&|<>]+"


def without_class(text: Column, name: str, pattern: str) -> Column:
    """A text without the characters of a class; white space, mostly single here, is quicker looked up than matched."""
    return F.translate(text, SPACES, "") if name == "space" else F.regexp_replace(text, pattern, "")


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: words, counts of the character classes, and the base figures."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))
    out = out.withColumn("left_0", F.col("text"))
    for k, (name, pattern) in enumerate(CLASSES):  # each pass reads only what the one before has left
        out = out.withColumn(f"left_{k + 1}", without_class(F.col(f"left_{k}"), name, pattern))
    sizes = [F.length(f"left_{k}") for k in range(len(CLASSES) + 1)]
    counts = F.array(*[(a - b) for a, b in zip(sizes, sizes[1:])], sizes[-1])
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    out = out.select(
        "doc_id", "lang", F.length("text").alias("n_chars"), words_of(F.col("text")).alias("words"), counts.alias("classes"),
        F.length("text").cast("long").alias("_all"), (sizes[1] - sizes[2]).alias("_space"),
        (F.length("left_2") - F.length(F.regexp_replace("left_2", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))
    # Windows of three words, as hash and place in one long, sorted: equal ones become neighbours.  The hash
    # loses PLACE_BITS bits to the place; where that makes different windows look equal (or a text has too
    # many words) the row takes the same way with hash and place side by side.
    out = out.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    low = (1 << PLACE_BITS) - 1
    out = out.withColumn("windows", F.when(n >= 3, F.transform(F.slice("hashes", 1, n - 2), lambda h, i: F.xxhash64(
        h, F.get("hashes", i + 1), F.get("hashes", i + 2)))).otherwise(F.array().cast("array<bigint>")))
    high = lambda x: F.shiftright(x, PLACE_BITS)
    out = out.withColumn("packed", F.sort_array(F.transform("windows", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))))
    out = out.withColumn("same", F.filter("packed", lambda x, k: (high(x) == high(F.get("packed", k - 1))) | (high(x) == high(F.get("packed", k + 1)))))
    full = lambda x: F.get("windows", x.bitwiseAND(F.lit(low)).cast("int"))
    clash = F.exists(F.transform("same", lambda x, k: (high(x) == high(F.get("same", k + 1))) & (full(x) != full(F.get("same", k + 1)))), lambda x: x)
    out = out.withColumn("clash", F.coalesce(clash, F.lit(False)) | (n > low))
    out = out.withColumn("pairs", F.when(F.col("clash"), F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    slow = F.transform(F.filter("pairs", lambda x, k: (x["h"] == F.get("pairs", k - 1)["h"]) | (x["h"] == F.get("pairs", k + 1)["h"])), lambda x: x["i"].cast("long"))
    fast = F.transform("same", lambda x: x.bitwiseAND(F.lit(low)))
    out = out.withColumn("again", F.sort_array(F.when(F.col("clash"), slow).otherwise(fast)))
    # a repeated window covers three words, or those up to the next one
    covered = F.aggregate(F.sequence(F.lit(0), F.size("again") - 1), F.lit(0).cast("long"), lambda acc, k: acc + F.least(F.coalesce(F.get("again", k + 1) - F.get("again", k), F.lit(3)), F.lit(3)).cast("long"))
    return out.select(
        "doc_id", "lang", "n_chars", "words", "classes", n.cast("long").alias("n_words"),
        (F.col("_all") - F.col("_space")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
        F.when(F.size("again") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"))


def class_counts(text: Column) -> Column:
    """The sizes of the character classes of a text, the rest last (as ``described`` has them)."""
    left, sizes = text, [F.length(text)]
    for name, pattern in CLASSES:
        left = without_class(left, name, pattern)
        sizes.append(F.length(left))
    return F.array(*[a - b for a, b in zip(sizes, sizes[1:])], sizes[-1])


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``ref_lang, common, word_shares, class_shares`` of every language, over all of its documents.

    Ties between equally frequent words go to the one that sorts first.
    """
    slim = docs.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where(F.col("lang").isNotNull())
    words = (slim.select("lang", F.explode(words_of(F.lower("text"))).alias("word"))
             .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = (words.withColumn("place", place).where(F.col("place") <= COMMON)  # at most COMMON rows of a task reach the final one
           .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("top")))
    counts = slim.select("lang", F.size(words_of(F.col("text"))).alias("n_words"), class_counts(F.col("text")).alias("c"))
    classes = counts.groupBy("lang").agg(F.sum("n_words").alias("n_words"), *[F.sum(F.get("c", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES) + 1)])
    both = top.join(classes, "lang")
    total = sum((F.col(f"c{k}") for k in range(1, len(CLASSES) + 1)), F.col("c0"))
    shares = F.transform("top", lambda x: x["n"] / F.col("n_words"))
    rest = F.aggregate(shares, F.lit(1.0), lambda acc, x: acc - x)
    return both.select(
        F.col("lang").alias("ref_lang"), F.transform("top", lambda x: x["word"]).alias("common"),
        F.concat(shares, F.array(rest)).alias("word_shares"),
        F.array(*[F.col(f"c{k}") / total for k in range(len(CLASSES) + 1)]).alias("class_shares"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as arrays of shares."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    halves = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(halves, F.lit(0.0), lambda acc, x: acc + x), F.lit(0.0)))


def judge(docs: DataFrame, refs: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base figures, both distances and the verdict for every document.

    ``base_failed``: under 50 words, or over half of the words in three-word
    windows that occur more than once.  ``kept``: not failed, and neither
    distance is too large.  A distance is null, and not held against the
    document, for a null language, one without a reference, or a text too
    short.  Null and blank texts have no words.  Repeated rows each give a
    row; an empty table gives none; other columns are not read.
    """
    refs = references(docs, text_col, lang_col) if refs is None else refs
    refs = refs.withColumns({"common_hashes": F.transform("common", lambda w: F.xxhash64(w)), "longest": F.array_max(F.transform("common", lambda w: F.length(w)))})
    rows = attach_lookup(described(docs, id_col, text_col, lang_col).withColumnRenamed("lang", "ref_lang"), refs, ["ref_lang"], F.col("doc_id"))
    # few words are no longer than a common one and have the hash of one (lower case never shortens); only they are looked up
    short = F.transform(F.filter("words", lambda w: F.length(w) <= F.col("longest")), lambda w: F.lower(w))
    rows = rows.withColumn("near", F.filter(short, lambda w: F.array_contains("common_hashes", F.xxhash64(w))))
    places = F.transform("near", lambda w: F.array_position("common", w))
    rows = rows.withColumn("hits", F.array_remove(F.when(F.col("common").isNotNull(), places), F.lit(0).cast("long")))
    count = F.transform(F.sequence(F.lit(1), F.size("common")), lambda k: F.size("hits") - F.size(F.array_remove("hits", k.cast("long"))))
    rows = rows.withColumn("word_hist", F.transform(F.concat(count, F.array(F.col("n_words").cast("int") - F.size("hits"))), lambda c: c / F.col("n_words")))
    class_hist = F.transform("classes", lambda c: c / F.col("n_chars"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    known = F.col("common").isNotNull()
    js_class = F.when(known & (F.col("n_chars") >= LEAST_CHARS), F.round(distance(class_hist, F.col("class_shares")), 6))
    js_word = F.when(known & (F.col("n_words") >= LEAST_WORDS), F.round(distance(F.col("word_hist"), F.col("word_shares")), 6))
    judged = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), js_class.alias("js_class"), js_word.alias("js_word"))
    far = (F.coalesce(F.col("js_class"), F.lit(0.0)) > MOST_CLASS) | (F.coalesce(F.col("js_word"), F.lit(0.0)) > MOST_WORD)
    return judged.withColumn("kept", ~F.col("base_failed") & ~far)


def oracle_sql() -> str:
    """DuckDB SQL for ``judge`` over the documents table."""
    space = "[ \\t-\\r]+"
    left, sizes = "t", ["length(t)"]
    for _, pattern in CLASSES:
        rule = pattern.replace("\\x20\\x09-\\x0D", " \\t-\\r").replace("'", "''")
        left = f"regexp_replace({left}, '{rule}', '', 'g')"
        sizes.append(f"length({left})")
    classes = ", ".join([f"{a} - {b}" for a, b in zip(sizes, sizes[1:])] + [sizes[-1]])
    k = len(CLASSES) + 1
    part = "(case when {a} > 0 then {a} * log2(2 * {a} / ({a} + {b})) else 0 end)"
    half = lambda a, b: f"({part.format(a=a, b=b)} + {part.format(a=b, b=a)}) / 2"
    return f"""
    with d as (select doc_id, lang, coalesce(text, '') as t from documents),
    w as (select doc_id, lang, t, list_filter(regexp_split_to_array(t, '{space}'), lambda x: x <> '') as ws, [{classes}] as cls from d),
    tok as (select doc_id, lang, unnest(ws) as word, unnest(range(len(ws))) as i from w),
    tri as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from (
        select doc_id, i, word as a, lead(word, 1) over o as b, lead(word, 2) over o as c from tok window o as (partition by doc_id order by i)) where c is not null),
    rep as (select doc_id, count(distinct j) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as j from tri where n > 1) group by 1),
    ln as (select doc_id, count(*) - count(distinct l) as n_dup_lines from (select doc_id, unnest(string_split(t, chr(10))) as l from d) where regexp_replace(l, '{space}', '', 'g') <> '' group by 1),
    freq as (select lang, lower(word) as word, count(*) as n from tok where lang is not null group by 1, 2),
    top as (select lang, word, n, row_number() over (partition by lang order by n desc, word) as place from freq qualify place <= {COMMON}),
    tot as (select lang, sum(len(ws)) as n_words, {", ".join(f"sum(cls[{i + 1}]) as c{i}" for i in range(k))} from w where lang is not null group by 1),
    refw as (select lang, place, word, n / n_words::double as q from top join tot using (lang)),
    refc as (select lang, unnest([{", ".join(f"c{i}" for i in range(k))}]) / ({" + ".join(f"c{i}" for i in range(k))})::double as q, unnest(range(1, {k + 1})) as place from tot where n_words > 0),
    base as (
      select doc_id, lang, len(ws)::bigint as n_words, length(t)::bigint as n_chars, length(regexp_replace(t, '{space}', '', 'g'))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words, cls
      from w left join ln using (doc_id) left join rep using (doc_id)),
    hits as (select doc_id, lang, lower(word) as word, count(*) as n from tok group by 1, 2, 3),
    pw as (select b.doc_id, q, coalesce(h.n, 0) / b.n_words::double as p from base b join refw r using (lang) left join hits h on h.doc_id = b.doc_id and h.word = r.word where b.n_words >= {LEAST_WORDS}),
    jw as (select doc_id, sum({half('p', 'q')}) + any_value({half('rp', 'rq')}) as js from (
        select doc_id, p, q, greatest(1 - sum(p) over (partition by doc_id), 0) as rp, greatest(1 - sum(q) over (partition by doc_id), 0) as rq from pw) group by 1),
    pc as (select doc_id, q, cls[place] / n_chars::double as p from base join refc using (lang) where n_chars >= {LEAST_CHARS}),
    jc as (select doc_id, sum({half('p', 'q')}) as js from pc group by 1),
    v as (
      select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        round(sqrt(if(jc.js < 0, 0, jc.js)), 6) as js_class, round(sqrt(if(jw.js < 0, 0, jw.js)), 6) as js_word
      from base left join jc using (doc_id) left join jw using (doc_id))
    select *, not base_failed and coalesce(js_class, 0) <= {MOST_CLASS} and coalesce(js_word, 0) <= {MOST_WORD} as kept from v
    """
