"""Bucketed tables: same rows, one file a bucket, no shuffle by the key they are stored by."""

import os
import re
import uuid

import pytest

from mercato.operators import orders as O
from mercato.sources.bucketed import BUCKET_KEYS, open_bucketed, write_bucketed
from mercato.sources.fixture import fixture_tables

SF = "/root/testdata/sf0.001"


def stored(tables, folder, buckets=4, keys=None):
    mark = f"t{uuid.uuid4().hex}"
    write_bucketed(tables, str(folder), mark, buckets, keys)
    return open_bucketed(next(iter(tables.values())).sparkSession, mark, list(tables))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_tables_come_back_whole(spark, tmp_path):
    tables = fixture_tables(spark, SF)
    back = stored(tables, tmp_path)
    for name in tables:
        assert back[name].schema.simpleString() == tables[name].schema.simpleString()
        assert rows(back[name]) == rows(tables[name])
    for name in BUCKET_KEYS:
        files = [f for f in os.listdir(tmp_path / name) if f.endswith(".parquet")]
        assert 0 < len(files) <= 4


def test_order_training_needs_no_exchange_by_order(spark, tmp_path, no_broadcast):
    tables = fixture_tables(spark, SF)
    back = stored(tables, tmp_path)
    by_order = lambda df: len(re.findall(r"Exchange hashpartitioning\(order_id", df._jdf.queryExecution().executedPlan().toString()))
    plain, own = (O.order_training(t, with_distance_seller_customer=False) for t in (tables, back))
    assert by_order(plain) >= 2 and by_order(own) == 0
    assert "SortMergeJoin" in own._jdf.queryExecution().executedPlan().toString()
    assert rows(own) == rows(plain)
    # with distances the paths by seller and by customer are the ones that still have to come back to the order
    whole = O.order_training(back)
    assert by_order(whole) < by_order(O.order_training(tables)) and rows(whole) == rows(O.order_training(tables))


def test_hard_cases(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), (None, 1), ("", None)], "order_id string, v int")
    back = stored({"orders": df, "other": df, "none": df.limit(0)}, tmp_path, 3, {"orders": "order_id", "none": "order_id"})
    assert all(rows(back[n]) == rows(df) for n in ("orders", "other")) and back["none"].count() == 0 and back["none"].columns == df.columns
    counts = {r["order_id"]: r["n"] for r in back["orders"].groupBy("order_id").agg({"*": "count"}).toDF("order_id", "n").collect()}
    assert counts == {None: 2, "a": 2, "": 1}
    with pytest.raises(ValueError):
        write_bucketed({"orders": df}, str(tmp_path / "x"), "x", 0)
    mark = f"t{uuid.uuid4().hex}"
    write_bucketed({"orders": df}, str(tmp_path / "y"), mark, 2)
    with pytest.raises(Exception, match="exist"):
        write_bucketed({"orders": df}, str(tmp_path / "y"), mark, 2)
