"""Filter interaction audit, vector code compression, license scans."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from cases import documents, empty, prose
from pyspark.sql import types as T

from mercato.llm import filter_audit, license_scan, vector_codes
from mercato.llm.common import read
from mercato.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MISSING = (None, math.nan, math.inf, -math.inf)


def same(a, b):
    """A short answer: pytest's own comparison of long lists takes minutes."""
    return len(a) == len(b) and not [1 for x, y in zip(a, b) if x != y]


@pytest.mark.parametrize("name,table", [("op11_filter_audit", "documents"), ("op12_vector_codes", "embeddings")])
def test_query_against_sql(spark, name, table):
    con = duckdb.connect()
    for t in {table, "labels"}:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    want = sorted(str(sorted(zip(names, r))) for r in cur.fetchall())
    assert same(sorted(str(sorted(r.asDict().items())) for r in QUERIES[name](spark, SF).collect()), want)


# ---------------------------------------------------------------- filter interaction audit
def failed(text, doc_id, smallest):
    words = WORD.findall(text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
    out += "D" if set(text) & set("#$%&*|") else ""
    return out + ("E" if doc_id is not None and smallest.get(text, doc_id) < doc_id else "")


def audited(docs, labels):
    """Every order applied to the documents one filter after the other."""
    smallest = {}
    for r in docs:
        if r["doc_id"] is not None:
            smallest[r["text"] or ""] = min(r["doc_id"], smallest.get(r["text"] or "", r["doc_id"]))
    good, toxic = ({r["doc_id"] for r in labels if r[c] == 1 and r["doc_id"] is not None} for c in ("quality", "toxic"))
    rows = [(r["lang"] or "", r["doc_id"], failed(r["text"] or "", r["doc_id"], smallest)) for r in docs]
    out = []
    for part in {r[0] for r in rows}:
        own, removed_by, found = [r for r in rows if r[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[2]]
                removed_by[f] += len(gone)
                left = [r for r in left if f not in r[2]]
                found.append((f, part, "".join(order), k + 1, len(left), len(gone), sum(f in r[2] for r in own) - len(gone), sum(r[2] == f for r in own),
                              sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone)))
        out += [(*x[1:], removed_by[x[0]]) for x in found]
    return sorted(out)


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("part_rows", [None, 2])
def test_audit_against_every_order_applied(spark, part_rows):
    rnd = random.Random(3)
    long_text = prose(1, 260)
    pool = [long_text, long_text.upper(), " ".join(f"w{k}" for k in range(250)), "same same " * 150, "short #", "", None, "Ab", " ".join(f"V{k}" for k in range(230)) + " |"]
    texts = [(rnd.choice([None, *range(-3, 40)]), rnd.choice(pool)) for _ in range(90)]
    labels = spark.createDataFrame([(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in [*range(-3, 30), 5, 6, 7, None]], "doc_id long, quality int, toxic int")
    for docs in (documents(spark), documents(spark, texts)):
        counted = filter_audit.combinations(filter_audit.failures(docs, part_rows=part_rows), labels)
        got = sorted(tuple(r) for r in filter_audit.interactions(counted).select(*COLUMNS).collect())
        want = audited(docs.collect(), labels.collect())
        assert same(got, want) and len(got) % 600 == 0
    assert any(r[9] for r in want) and any(r[7] for r in want)


def test_audit_of_equal_hashes_compares_texts(spark, monkeypatch):
    """With one hash for all texts only equal ones are copies."""
    from pyspark.sql import functions as F

    keyed = filter_audit.keyed
    monkeypatch.setattr(filter_audit, "keyed", lambda *a: keyed(*a).withColumn("h", F.lit(7).cast("long") + F.col("doc_id") * 0))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c"), (6, None), (7, "")], "doc_id long, text string").selectExpr("*", "'x' as lang")
    marked = filter_audit.failures(docs).where("bits >= 16").collect()
    assert sorted(r["doc_id"] for r in marked) == [3, 4, 7]


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), labels).count() == 0
    assert filter_audit.audit(documents(spark), labels).agg({"good_lost": "sum", "toxic_lost": "sum"}).collect()[0][0:2] == (0, 0)


# ---------------------------------------------------------------- vector code compression
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        T.StructField("x", T.StringType()), T.StructField("own", T.StringType()), T.StructField("code", T.StringType())])


def plain_codes(vectors, parts, entries, rounds):
    """Plain search, Python integers."""
    def wrong(v):
        return not v or len(v) % parts or any(x is None or math.isnan(x) or math.isinf(x) for x in v)

    kept = sorted(((i is None, i or 0, tuple(v)) for i, v in vectors if not wrong(v)))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = [[tuple(math.floor(x * 256) for x in v[p * width:(p + 1) * width]) for p in range(parts)] for *_, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(col) // len(members[e]) for col in zip(*members[e])) if e in members else books[p][e] for e in range(len(books[p]))]
    out = []
    for (none, i, _), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((none, i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return sorted(out), [x for b in books for e in b for x in e]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "o", "c") for i, v, lab in rows], VECTORS)


@pytest.mark.parametrize("rounds,spread", [(2, 1.0), (5, 0.05), (6, 1.0)])
def test_codes_are_those_of_plain_search(spark, rounds, spread):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(9, 32))
    rows = [(int(rnd.integers(0, 300)), [float(np.float32(x)) for x in centres[rnd.integers(9)] * 0.3 + spread * rnd.normal(size=32) * 0.2], int(rnd.integers(0, 4)) if k % 5 else None) for k in range(400)]
    rows += [(i, list(v), 1) for i, v, _ in rows[:30]]  # repeated rows, so ties
    rows += [(None, rows[3][1], None), (1, None, 2), (2, [], 2), (3, [1.0] * 31, 2), (4, [1.0] * 16, 2), *[(-k, [0.5] * 31 + [x], 2) for k, x in enumerate(MISSING)]]
    df = vectors(spark, rows)
    coded, books = vector_codes.compress(df, entries=16, rounds=rounds)
    want, want_books = plain_codes([(i, v) for i, v, _ in rows], 16, 16, rounds)
    assert same(sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in coded.collect()), want)
    assert books.ravel().tolist() == want_books
    told = vector_codes.summary(df, entries=16, rounds=rounds).collect()
    of = {}
    label = {r["vec_id"]: 0 for r in told}
    for r in coded.collect():
        of[r["label"]] = of.get(r["label"], 0) + r["error"]
        label.setdefault(r["vec_id"], r["label"])
    assert sorted(r["label_error"] for r in told) == sorted(of[r["label"]] for r in coded.collect())
    assert {r["codebooks_sha256"] for r in told} == {hashlib.sha256(",".join(map(str, want_books)).encode()).hexdigest()}


def test_few_and_no_vectors(spark):
    rows = [(5, [0.25 * k for k in range(16)], 1), (6, [1.0] * 16, None)]
    coded, books = vector_codes.compress(vectors(spark, rows))
    assert books.shape == (16, 2, 1) and {r["error"] for r in coded.collect()} == {0}
    one, _ = vector_codes.compress(vectors(spark, rows[:1]))
    assert [(r["vec_id"], r["code"], r["error"]) for r in one.collect()] == [(5, "00" * 16, 0)]
    for nothing in ([], [(1, None, 1), (2, [math.nan] * 16, 1)]):
        assert vector_codes.summary(vectors(spark, nothing)).count() == 0


def test_very_large_components_do_not_overflow(spark):
    rows = [(k, [float(np.float32(x)) for x in ([3e38] * 8 + [-3e38] * 8 if k % 2 else [k * 1e5] * 16)], k % 2) for k in range(40)]
    coded = vector_codes.compress(vectors(spark, rows), entries=2)[0].collect()
    assert len(coded) == 40 and all(0 <= r["error"] < 2**63 for r in coded)


def test_bounds_spare_distances_and_stay_bounds():
    """Of clustered parts whose entries move little most are settled by their bounds; every bound holds."""
    rnd = np.random.default_rng(2)
    entries = rnd.integers(-2000, 2000, (64, 4))
    x = entries[rnd.integers(0, 64, 3000)] + rnd.integers(-40, 40, (3000, 4))
    b = vector_codes.Bounds.measured(x, entries, 16)
    looked_all = []
    for _ in range(3):
        new = entries + rnd.integers(-30, 30, entries.shape)
        b = b.moved(np.sqrt(np.square(new - entries).sum(1).astype(float)), 12)
        entries = new
        looked_all.append(b.settle(x, entries))
        d = np.square(x[:, None, :] - entries[None]).sum(2)
        assert (b.own == d.argmin(1)).all()
        root = np.sqrt(d)
        assert (b.upper >= root[np.arange(3000), b.own]).all()
        for k in range(12):
            assert (b.lower[:, k] <= root[np.arange(3000), b.near[:, k]]).all()
        others = np.ones_like(d, bool)
        others[np.arange(3000), b.own] = False
        for k in range(12):
            others[np.arange(3000), b.near[:, k]] = False
        assert (b.outer <= np.where(others, root, np.inf).min(1)).all()
    assert (looked_all[0] == 0).mean() > 0.8


def test_number_of_bounds_follows_the_looks():
    assert vector_codes.adapted({0: 900, 1: 100}, 16, 64) == 8
    assert vector_codes.adapted({0: 0, 12: 100}, 16, 64) == 12
    assert vector_codes.adapted({0: 0, 17: 100}, 16, 64) == 16
    assert vector_codes.adapted({}, 16, 64) == 8


# ---------------------------------------------------------------- license scans
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def scanned(texts):
    """The method by counting: all beginnings of every notice, one after the other."""
    split = [license_words(t) for t in texts]
    df = Counter(w for words in split for w in set(words))
    idf = {w: math.log((len(texts) + 1) / (df.get(w, 0) + 1)) for w in license_scan.vocabulary()}
    out = []
    for words in split:
        held, found = set(words), {}
        for label, notice, phrases in license_scan.NOTICES:
            own = notice.split()
            ranked = sorted(set(own), key=lambda w: (-idf[w], w))
            needed = math.ceil(license_scan.AGREE * min(license_scan.RARE, len(ranked)))
            rare = [w for w in ranked if w in held][:license_scan.RARE]
            starts = [(i - k, w) for i, w in enumerate(words) if w in rare for k, x in enumerate(own) if x == w]
            for box in {s // license_scan.SLACK - k for s, _ in starts for k in (0, 1)}:
                low = box * license_scan.SLACK
                if len({w for s, w in starts if low <= s < low + 2 * license_scan.SLACK}) < needed:
                    continue
                near = lambda p: any(abs(at - own_at - low - license_scan.SLACK) <= 2 * license_scan.SLACK for at in places(words, p) for own_at in places(own, p)[:1])
                if all(near(p) for p in phrases):
                    window = words[max(low, 0):max(low, 0) + len(own) + 2 * license_scan.SLACK]
                    found[label] = max(found.get(label, 0), len(set(ranked) & set(window)) / len(ranked))
        at = {label: places(words, phrase) for label, phrase in license_scan.BASE}
        every = [i for x in at.values() for i in x]
        base = sorted(k for k, x in at.items() if x)
        score = 0.5 + max(found.values()) / 2 if found else 0.5 if every else 0.0
        out.append((len(words), len(every), min(every, default=None), max(every, default=None), ",".join(base), ",".join(sorted({*base, *found})), score))
    return out


def check_scan(spark, docs):
    got = license_scan.summary(docs).collect()
    rows = docs.collect()
    order = lambda x: str(x)
    want = sorted(((r["doc_id"], *x) for r, x in zip(rows, scanned([r["text"] for r in rows]))), key=order)
    assert same(sorted((tuple(r) for r in got), key=order), want)
    return want


def test_scan_against_counting_on_notices(spark):
    rnd = random.Random(6)
    texts = [(1000, "# All Rights Reserved.\n" * 3), (1001, "cc by general public license all rights all rights reserved cc"), (1002, "CC-BY; ALL rights\x00reserved"), (1003, "ris\u212a all rights re\u0130erved"),
             (1004, "license " * 3000 + "the software " * 2000 + "permission is hereby granted without restriction"), (1005, "cc by"), (1006, "all rights reservedé")]
    for k in range(160):
        label, notice, _ = license_scan.NOTICES[k % len(license_scan.NOTICES)]
        words = notice.split()
        if k % 3 == 1:  # an inserted name, a changed word
            words.insert(rnd.randrange(len(words)), "acme")
            words[rnd.randrange(len(words))] = "other"
        if k % 3 == 2:  # all its words out of order
            rnd.shuffle(words)
        more = prose(k, rnd.randint(0, 60)).split()
        at = rnd.randint(0, len(more))
        texts.append((k, rnd.choice([" ", "\n// ", " * "]).join([*more[:at], *words, *more[at:]]).title() if k % 2 else " ".join([*more[:at], *words, *more[at:]])))
    want = check_scan(spark, documents(spark, texts))
    of = {r[0]: r[6].split(",") for r in want}
    whole = [k for k in range(160) if k % 3 == 0]
    assert all(license_scan.NOTICES[k % 16][0] in of[k] for k in whole)
    shuffled = [k for k in range(160) if k % 3 == 2 and len(license_scan.NOTICES[k % 16][1].split()) > 20]
    assert shuffled and not any(license_scan.NOTICES[k % 16][0] in of[k] for k in shuffled)


def test_scan_against_counting_on_documents(spark):
    want = check_scan(spark, read(spark, SF, "documents"))
    assert {"apache-2.0", "mit", "cc-by-nc", "reserved"} <= {x for r in want for x in r[6].split(",")}


def test_scan_of_hard_cases(spark):
    docs = documents(spark)
    check_scan(spark, docs)
    assert license_scan.summary(empty(spark)).count() == 0
    out = license_scan.scan(docs, out_col="words")
    assert out.columns == docs.columns and out.schema["words"].dataType.typeName() == "struct"


def test_scan_stays_in_the_jvm(spark):
    plan = license_scan.summary(read(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
