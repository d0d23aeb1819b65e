import math

import duckdb

from mercato.compare import canonical, canonical_sql

VALUES = [0.0, -0.0, 1e-3, 1e-3 * (1 + 1e-6), 1.0, -123.456, 1e18, 3e300, 1e-9, 1e-30, 5e-324, float("nan"), float("inf"), float("-inf"), None, 0.1 + 0.2, 0.3]


def both(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v double")
    ours = [r["v"] for r in canonical(df).orderBy("i").collect()]
    con = duckdb.connect()
    con.execute("create table t (i int, v double)")
    con.executemany("insert into t values (?, ?)", [(i, v) for i, v in enumerate(VALUES)])
    theirs = [v for _, v in con.execute(canonical_sql("select * from t", ["v"]) + " order by i").fetchall()]
    return ours, theirs


def test_both_engines_give_the_same_bits(spark):
    ours, theirs = both(spark)
    assert [repr(x) for x in ours] == [repr(x) for x in theirs]


def test_nothing_is_hidden(spark):
    ours = dict(enumerate(both(spark)[0]))
    assert ours[2] != ours[3]  # a relative error of 1e-6 on 1e-3
    assert math.isnan(ours[11]) and ours[12] == float("inf") and ours[13] == float("-inf") and ours[14] is None
    assert abs(ours[6] / 1e18 - 1) < 1e-7 and abs(ours[7] / 3e300 - 1) < 1e-7
    assert ours[15] == ours[16]  # the last bits of a sum


def test_order_of_summation_does_not_show(spark):
    a = spark.createDataFrame([(sum([0.1] * 1000),)], "v double")
    b = spark.createDataFrame([(math.fsum([0.1] * 1000),)], "v double")
    assert canonical(a).first() == canonical(b).first()
