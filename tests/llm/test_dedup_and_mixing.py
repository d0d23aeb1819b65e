"""Mixing, substring dedup, SimHash, line dedup, components and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from cases import documents, empty, prose

from mercato.llm import line_dedup, mixing, simhash_cover, substring_dedup
from mercato.llm.common import read
from mercato.llm.components import connected_components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def same(a, b):
    """A short answer: pytest's own comparison of long lists takes minutes."""
    return len(a) == len(b) and not [1 for x, y in zip(a, b) if x != y]


def groups_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


def test_components_of_random_graphs(spark):
    rnd = random.Random(6)
    n = 400
    links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(260)] + [(k, k + 1) for k in range(300, 380)] + [(5, k) for k in range(20, 60)]
    df = spark.createDataFrame([(a, b, "x") for a, b in links] + [(None, 3, "x"), (4, None, "y")], "a long, b long, node string")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    want = groups_of(n, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert connected_components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- mixing
def test_mixture_equals_its_sql(spark):
    from mercato.llm.queries import ORACLE_SQL, op1_mixing

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    cur = con.execute(ORACLE_SQL["op1_mixing"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(sorted(zip(names, r))) for r in cur.fetchall())
    assert same(sorted(tuple(sorted(r.asDict().items())) for r in op1_mixing(spark, SF).collect()), want)


def test_mixture_meets_the_weights(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('text number ', id) as text", "if(id < 4500, 'big', if(id < 5995, 'mid', 'tiny')) as source")
    mixed = mixing.mix(docs, {"big": 1.0, "mid": 2.0, "tiny": 1.0}, epochs=2.0)
    size = {r["source"]: r["n"] for r in mixed.groupBy("source").agg({"text": "count"}).withColumnRenamed("count(text)", "n").collect()}
    whole = sum(size.values())
    assert size["big"] / whole == pytest.approx(0.25, abs=0.03) and size["mid"] / whole == pytest.approx(0.5, abs=0.03)
    assert size["tiny"] / whole == pytest.approx(0.25, abs=0.03)  # five documents, each hundreds of times
    big = mixed.where("source = 'big' and _copy = 0").groupBy("_copies").count().collect()
    rate = 0.25 * 2 * 6000 / 4500
    ones = next(r["count"] for r in big if r["_copies"] == 1) / 4500
    assert ones == pytest.approx(rate * np.exp(-rate), abs=0.03)
    places = [r["_place"] for r in mixed.select("_place").collect()]
    assert same(places, sorted(places))  # a global order
    again = mixing.mix(docs.repartition(7), {"big": 1.0, "mid": 2.0, "tiny": 1.0}, epochs=2.0)
    assert same(sorted(mixed.collect()), sorted(again.collect()))


def test_mixture_of_hard_cases(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c != "_place"] + ["_copies", "_copy", "_place"]
    counts = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    drawn = {(r["doc_id"], r["text"]): r["_copies"] for r in mixed.collect()}
    times = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert all(counts[k] == n * times[k] for k, n in drawn.items())
    assert mixing.mix(empty(spark)).count() == 0
    assert {r["source"] for r in mixing.mix(docs, {"s1": 1.0}, epochs=5).collect()} == {"s1"}


# ---------------------------------------------------------------- substring dedup
def without_repeats(texts, window):
    least, out = {}, []
    split = [(i, WORD.findall(t or "")) for i, t in texts]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            rank = (i is None, i or 0)
            least[key] = min(least.get(key, rank), rank)
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < (i is None, i or 0):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i is None, i or 0, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block_chars", [8_000_000, 400])
def test_substrings_against_plain_python(spark, block_chars):
    rnd = random.Random(8)
    texts = [(k, " ".join([prose(rnd.randrange(6), 30), prose(100 + k, 20), prose(rnd.randrange(6), 18)])) for k in range(40)]
    for docs in (documents(spark), documents(spark, texts)):
        got = substring_dedup.drop_repeated_substrings(docs, block_chars=block_chars).collect()
        want = without_repeats([(r["doc_id"], r["text"]) for r in docs.collect()], 13)
        assert same(sorted((r[0] is None, r[0] or 0, *r[1:]) for r in got), want)
    assert sum(x[3] for x in want) > 300
    assert substring_dedup.drop_repeated_substrings(empty(spark)).count() == 0


def test_sketches_are_packed_without_loss_and_never_underestimate():
    rng = np.random.default_rng(1)
    for n in (0, 1, 50, 5000, 60_000):
        cells = np.sort(rng.integers(0, substring_dedup.CELLS, n, dtype=np.uint32))
        assert (substring_dedup.unpack(substring_dedup.pack(cells)) == cells).all()


# ---------------------------------------------------------------- simhash
def simhash(text):
    words = [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    bits = 0
    for b in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1 for g in grams) > len(grams):
            bits |= 1 << b
    return bits


def test_fingerprints_and_components_against_all_pairs(spark):
    base = prose(50, 300).split()
    texts = [(1000 + k, " ".join(base[:k * 7] + ["edit"] + base[k * 7 + 1:])) for k in range(30)]
    docs = documents(spark).unionByName(documents(spark, texts)).unionByName(documents(spark, [(r["doc_id"] + 2000, r["text"]) for r in read(spark, SF, "documents").collect()]))
    rows = docs.collect()
    prints = [simhash(r["text"]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    group = groups_of(len(rows), links)
    name = {}
    for g, r in zip(group, rows):
        if r["doc_id"] is not None:
            name[g] = min(name.get(g, r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"] is None, r["doc_id"] or 0, p, name.get(g)) for r, p, g in zip(rows, prints, group)]
    got = simhash_cover.near_duplicates(docs).collect()
    key = lambda x: (*x[:3], x[3] is None, x[3] or 0)
    assert same(sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["print"] % 2**64, r["component_id"]) for r in got), key=key), sorted(want, key=key))
    kept = simhash_cover.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert same(sorted(r["doc_id"] for r in kept.collect()), sorted(name.values()))
    assert simhash_cover.near_duplicates(empty(spark)).count() == 0


def test_ties_between_rows_of_one_id_are_settled(spark):
    words = "alpha beta gamma delta epsilon zeta"
    rows = [(1, words, "en"), (1, words.upper(), "de"), (1, words.upper(), "fr"), (2, words, "en"), (None, "other words that stand apart here", "en"), (None, "other words that stand apart here", "de")]
    kept = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        got = simhash_cover.keep_representatives(docs)
        assert got.columns == docs.columns
        kept.add(tuple(sorted((str(tuple(r)) for r in got.collect()))))
    (only,) = kept
    assert len(only) == 2 and any(words.upper() in r and r.startswith("(1,") for r in only) and any(r.startswith("(None,") for r in only)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_linked_fingerprints_share_an_anchor(bits):
    rng = np.random.default_rng(bits)
    cover = simhash_cover.Cover(bits)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, bits + 1), replace=False)) for _ in a], np.uint64)
    for x, y in zip(a, a ^ flips):
        _, one = cover.anchors(np.array([x], np.uint64))
        _, two = cover.anchors(np.array([y], np.uint64))
        assert set(one.tolist()) & set(two.tolist())


def test_hot_anchors_are_cut_into_tiles(spark, monkeypatch):
    rng = np.random.default_rng(3)
    center = 0x0123456789ABCDEF
    prints = {center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False)) for _ in range(600)}
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    want = groups_of(len(prints), [(a, b) for a in range(len(prints)) for b in range(a) if ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 4])

    def found():
        at = {p: k for k, p in enumerate(prints)}
        return groups_of(len(prints), [(at[r["a"]], at[r["b"]]) for r in simhash_cover.links(df).collect()])

    assert same(found(), want)
    monkeypatch.setattr(simhash_cover, "HOT", 20)
    assert same(found(), want)


def test_large_groups_breadth_first():
    rng = np.random.default_rng(4)
    prints = np.unique(np.array([sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)) for _ in range(4000)], np.uint64))
    keys = np.zeros(len(prints), np.int64)
    a, b = simhash_cover.links_of_run(keys, prints, 4)
    assert len(prints) > 2000
    at = {int(p): k for k, p in enumerate(prints)}
    assert len(set(groups_of(len(prints), [(at[int(x)], at[int(y)]) for x, y in zip(a, b)]))) == 1  # all hang on zero


# ---------------------------------------------------------------- line dedup
def kept_lines(rows, similarity=0.8):
    shingle = re.compile(line_dedup.PATTERN)
    where, out = {}, []
    for r in rows:
        for k, line in enumerate((r["text"] or "").split("\n") if r["text"] is not None else []):
            x = line.strip(" \t\n\x0b\x0c\r")
            if any(c.isalnum() for c in x):
                where.setdefault(x, []).append((r["doc_id"] is None, r["doc_id"] or 0, r["of"], k))
    lines = list(where)
    sets = [set(shingle.findall(x)) for x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if min(len(lines[a]), len(lines[b])) >= line_dedup.LEAST and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    group = dict(zip(lines, groups_of(len(lines), links)))
    first = {}
    for x in lines:
        first[group[x]] = min(first.get(group[x], min(where[x])), min(where[x]))
    for r in rows:
        if r["text"] is None:
            out.append((r["doc_id"], None))
            continue
        stay = []
        for k, line in enumerate(r["text"].split("\n")):
            x = line.strip(" \t\n\x0b\x0c\r")
            if x not in where or first[group[x]] == (r["doc_id"] is None, r["doc_id"] or 0, r["of"], k):
                stay.append(line)
        out.append((r["doc_id"], "\n".join(stay)))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))


def test_lines_against_plain_python(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(12)
    lines = [prose(300 + k, 40) for k in range(12)]

    def varied(line):
        words = line.split()
        words[rnd.randrange(40)] = rnd.choice(["edit", "other", "alpha"])
        return " ".join(words)

    texts = [(k, "\n".join([varied(rnd.choice(lines)) for _ in range(3)] + ["", "short", rnd.choice(lines) + " "])) for k in range(40)]
    for docs in (documents(spark), documents(spark, texts)):
        done = line_dedup.drop_repeated_lines(docs)
        assert done.columns == docs.columns
        got = sorted(((r["doc_id"], r["text"]) for r in done.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
        assert same(got, kept_lines(docs.withColumn("of", F.xxhash64("text")).collect()))
        assert all(r["n_chars"] == len(r["text"] or "") for r in done.collect())
    assert line_dedup.drop_repeated_lines(empty(spark)).count() == 0


def test_line_recall_on_documents(spark):
    """Banding may miss a pair near the threshold; never is a line removed that brute force keeps."""
    from pyspark.sql import functions as F

    docs = read(spark, SF, "documents")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs).collect()}
    want = dict(kept_lines(docs.withColumn("of", F.xxhash64("text")).collect()))
    lines = lambda texts: sum(len(t.split("\n")) for t in texts.values())
    before = sum(len(r["text"].split("\n")) for r in docs.collect())
    assert all(set(want[k].split("\n")) <= set(got[k].split("\n")) for k in got)
    assert before - lines(got) >= 0.98 * (before - lines(want))


def full_shingles(line, size=5):
    """By plain slicing, not by the module's own pattern."""
    return {line[k:k + size] for k in range(len(line) - size + 1)}


def lines_left(spark, lines):
    docs = documents(spark, list(enumerate(lines)))
    return {r["doc_id"] for r in line_dedup.drop_repeated_lines(docs).collect() if r["text"]}


def test_a_pair_of_lines_is_encoded_once_each(spark):
    """The optimised plan brings either line into the form its shingles are cut from once, and its time grows with the line."""
    import time

    from pyspark.sql import functions as F

    def rows(n):
        return spark.createDataFrame([(prose(k, n), prose(k, n - 3) + " alpha beta gamma") for k in range(40)], "line_a string, line_b string").repartition(4)

    def pairs(n):
        return rows(n).where(line_dedup.similar(F.col("line_a"), F.col("line_b"), 0.8))

    plan = pairs(10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("encode(") <= 2 and plan.count("array_intersect(") == 1
    took = []
    for n in (200, 2000, 8000, 16_000):
        began = time.time()
        assert pairs(n).count() == 40
        took.append(time.time() - began)
    assert took[3] < 3 * took[2] + 1


def test_long_lines_that_differ_make_no_pairs(spark):
    """Maps of long lines are nearly full of bits; with the numbers of distinct shingles they still tell lines apart, and rule out no similar pair."""
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = ["".join(rnd.choices(letters, k=1500 + 40 * k)) for k in range(30)]
    lines += ["".join(rnd.choice(letters) if rnd.random() < share else c for c in lines[k]) for k in range(8) for share in (0.002, 0.01, 0.02, 0.03)]
    lines += ["abcdefgh" * 20]
    known = spark.createDataFrame([(k, 1, line, [7]) for k, line in enumerate(lines)], "id long, n long, line string, buckets array<long>")
    mapped = line_dedup.with_maps(known)
    sets = [full_shingles(line) for line in lines]
    assert {r["id"]: r["size"] for r in mapped.collect()} == {k: len(x) for k, x in enumerate(sets)}
    got = {(r["a"], r["b"]) for r in line_dedup.remaining_pairs(mapped, spark.createDataFrame([], "node long, root long"), 0.8).collect()}
    likeness = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in range(len(lines)) for a in range(b)}
    similar = {pair for pair, x in likeness.items() if x >= 0.8}
    assert similar and similar <= got and all(likeness[pair] > 0.4 for pair in got)


def test_lines_that_share_a_bucket_by_chance_are_no_candidates(spark):
    """Long lines of few words agree in some band; the rest of their signatures tells them from similar ones, of which none is lost."""
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=3)) for _ in range(30)]
    lines = [" ".join(rnd.choices(words, k=150)) for _ in range(120)]
    near = [" ".join(w if rnd.random() > 0.02 else "edit" for w in line.split()) for line in lines[:15]]
    sets = [full_shingles(line) for line in lines + near]
    similar = {k for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for k in (a, b)}
    judged = line_dedup.judged_lines(documents(spark, list(enumerate(lines + near))))
    shared = line_dedup.signatures(judged).select("id", F.explode(F.array(*[line_dedup.band(b) for b in range(line_dedup.BANDS)])).alias("bucket"))
    alone = {r["bucket"] for r in shared.groupBy("bucket").count().where("count = 1").collect()}
    by_chance = {r["id"] for r in shared.collect() if r["bucket"] not in alone}
    got = {r["id"] for r in line_dedup.shared_buckets(judged, 0.8).collect()}
    assert {r["id"] for r in judged.collect() if r["doc_id"] in similar} <= got
    assert len(got) < 0.6 * len(by_chance)


def test_pairs_that_join_nothing_are_not_judged(spark, monkeypatch):
    """Of the pairs of a group of near copies as many are judged as it takes to join it, and groups come out as by judging all."""
    rnd = random.Random(9)
    lines = [prose(700 + g, 40).split() for g in range(3)]
    edits = [rnd.randrange(40) for _ in range(36)]
    lines = [" ".join(w if k != edits[j] else "edit" for k, w in enumerate(lines[j % 3])) for j in range(36)]
    known = spark.createDataFrame([(k, 1, line, [7]) for k, line in enumerate(lines)], "id long, n long, line string, buckets array<long>")
    pairs = [(a, b) for b in range(len(lines)) for a in range(b) if a % 3 == b % 3 or a == 20]
    judged, verified = [], line_dedup.verified

    def watched(pairs, known, similarity):
        judged.extend((r["a"], r["b"]) for r in pairs().collect())
        return verified(pairs, known, similarity)

    monkeypatch.setattr(line_dedup, "verified", watched)
    made = spark.createDataFrame(pairs, "a long, b long")
    got = [(r["a"], r["b"]) for r in line_dedup.linked(lambda: made, known, 0.8).collect()]
    sets = [full_shingles(line) for line in lines]
    links = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(links) > 150 and same(groups_of(len(lines), got), groups_of(len(lines), links)) and set(got) <= set(links)
    assert len(judged) == len(set(judged)) and len(set(judged) & set(links)) < len(links) / 2


def test_files_of_a_stored_step_go_when_it_ends(spark, monkeypatch):
    """Shuffle files lie on the disk no longer than the step that made them, though its DataFrame is held and no garbage collected; the session's setting stays."""
    import pathlib
    import time

    from mercato.llm import common

    monkeypatch.setattr(common, "released", lambda *a: None, raising=False)
    folders = [pathlib.Path(str(x)) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {x for d in folders for x in d.rglob("shuffle_*")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    df = spark.range(1000).repartition(5, "id").groupBy("id").count()
    held = common.stored(df)
    for _ in range(40):
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before
    assert held.count() == df.count() == 1000 and spark.conf.get(key) == setting


def exchanges(df):
    """The exchanges of a plan that has run, each with whether it was made anew."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [(line, "ReusedExchange" not in line) for line in plan.split("\n") if re.search(r"Exchange (hash|single|range)|ReusedExchange", line)]


def test_lines_go_to_their_buckets_once(spark):
    """Hubs are met where the rows of a bucket lie; both sides of the pairs left are one shuffle, without the lists of buckets."""
    lines = [prose(k, 30) for k in range(20)] + [prose(k, 30) + " edit" for k in range(6)]
    known = spark.createDataFrame([(k, 1, line, [k % 3, 7]) for k, line in enumerate(lines)], "id long, n long, line string, buckets array<long>")
    mapped = line_dedup.with_maps(known).checkpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hubs = exchanges(line_dedup.hub_pairs(mapped, 0.8))
        left = exchanges(line_dedup.remaining_pairs(mapped, spark.createDataFrame([], "node long, root long"), 0.8))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(hubs) == 2  # to the buckets, and the pairs by their ends
    wide = re.compile(r"hashpartitioning\(bucket_a|hashpartitioning\(bucket_b")
    assert sum(made for line, made in left if wide.search(line)) == 1


def test_buckets_of_several_parts_lose_no_pair(spark, monkeypatch):
    """With parts of 5 lines and 2 hubs the same lines stay as by comparing all pairs."""
    from pyspark.sql import functions as F

    rnd = random.Random(5)
    lines = [prose(500 + k, 40) for k in range(3)]

    def varied(line):
        words = line.split()
        words[rnd.randrange(40)] = rnd.choice(["edit", "other", "alpha", "beta"])
        return " ".join(words)

    docs = documents(spark, [(k, "\n".join(varied(rnd.choice(lines)) for _ in range(3))) for k in range(30)])
    monkeypatch.setattr(line_dedup, "TASK", 5)
    monkeypatch.setattr(line_dedup, "HUBS", 2)
    got = sorted(((r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    assert same(got, kept_lines(docs.withColumn("of", F.xxhash64("text")).collect()))


def test_short_lines_go_only_if_they_repeat_exactly(spark):
    lines = ["Read more", "Read more!", "}", "}", "Read more", "---", "---", "a", "a "]
    assert lines_left(spark, lines) == {0, 1, 2, 3, 5, 6, 7}


def test_lines_of_one_hash_are_not_taken_for_each_other(spark, monkeypatch):
    from pyspark.sql import functions as F

    judged = line_dedup.judged_lines
    monkeypatch.setattr(line_dedup, "judged_lines", lambda *a: judged(*a).withColumn("id", F.when(F.col("line").startswith("same"), 5).otherwise(F.col("id")).cast("long")))
    lines = ["same " + prose(1, 30), "same " + prose(2, 30), prose(3, 30), prose(3, 30)]
    assert lines_left(spark, lines) == {0, 1, 2}


def test_lines_without_spaces_are_judged_in_whole(spark):
    start = "https://www.example.com/"
    chinese = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u4e00\u8d77\u53bb\u516c\u56ed\u6563\u6b65\u5427"  # 17 characters
    different = [start + "products/alpha", start + "about/contact-us", chinese + "\u7136\u540e\u56de\u5bb6\u5403\u996d\u770b\u4e66",
                 chinese + "\u660e\u5e74\u6211\u60f3\u5b66\u4e60\u5f39\u94a2\u7434\u548c\u753b\u753b", "\U0001F600" * 16 + "abcdefghijklmnop", "\U0001F600" * 16 + "qrstuvwxyzABCDEF"]
    near = [chr(0x4E00 + 37 * k % 5000) for k in range(90)]
    near = ["".join(near), "".join(near[:40] + ["x"] + near[41:])]
    lines = different + near
    for a in range(len(different)):
        for b in range(a):
            x, y = full_shingles(different[a]), full_shingles(different[b])
            assert len(x & y) < 0.8 * len(x | y)
    assert lines_left(spark, lines) == set(range(len(lines) - 1))


def test_lines_with_one_changed_character(spark):
    rnd = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines, linked = [], 0
    for _ in range(150):
        line = ""
        while len(line) < 50:
            line = " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(9, 20)))[:150].strip()
        k = rnd.randrange(len(line))
        lines += [line, line[:k] + "7" + line[k + 1:]]
        x, y = full_shingles(lines[-2]), full_shingles(lines[-1])
        linked += len(x & y) >= 0.8 * len(x | y)
    left = lines_left(spark, lines)
    assert linked >= 0.98 * 150  # of words' starts far fewer
    assert left >= set(range(0, len(lines), 2))
    assert 0.98 * linked <= len(lines) - len(left) <= linked


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from mercato.llm.bpe import Bpe, Encoder, load_spec
    from mercato.llm.queries import word_vocabulary

    docs = read(spark, SF, "documents")
    kept = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert sorted(kept[-1].columns) == sorted(docs.columns)
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in kept]
    assert len(ids[1]) > 0.95 * len(ids[0]) and ids[2] == ids[1] and ids[3] < ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]
    # near copies: one document of each group of the stage's own input
    prints = {r["doc_id"]: simhash(r["text"]) for r in kept[2].collect()}
    left = sorted(ids[3])
    assert all((prints[a] ^ prints[b]).bit_count() > 4 for k, a in enumerate(left) for b in left[:k])
    # the last stage encodes every copy of the mixture
    texts = {r["doc_id"]: r["text"] for r in kept[4].collect()}
    import json

    encoder = Encoder(Bpe(json.loads(load_spec(word_vocabulary()))))
    for r in kept[5].collect()[:50]:
        assert list(r["ids"]) == encoder.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
    assert kept[5].count() == kept[4].count()


def test_whole_rows_are_dealt_once_for_representatives(spark):
    """What the join with the chosen keys deals the rows by also serves their grouping: no exchange above the join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash_cover.keep_representatives(documents(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan.split("SortMergeJoin")[0]
    assert "Aggregate" in above and "Exchange" not in above


def test_representatives_of_rows_without_id_and_of_id_zero(spark):
    """No id is told from id zero; of the same id and text one row stays."""
    rows = [(0, prose(1, 40)), (None, prose(2, 40)), (0, prose(3, 40)), (None, prose(3, 40)), (0, prose(1, 40)), (7, prose(2, 40)), (None, prose(4, 40))]
    kept = simhash_cover.keep_representatives(documents(spark, rows), max_bits=0).select("doc_id", "text").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept) == sorted(
        [(False, 0, prose(1, 40)), (False, 0, prose(3, 40)), (False, 7, prose(2, 40)), (True, 0, prose(4, 40))])
