import math

import pytest
from helpers import item, make_tables, order

from mercato.operators import orders as O


def rows(df, key="order_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(
        spark,
        orders=[
            order("o1", purchase=0, delivered=3, estimated=5),        # early: delay 0
            order("o2", purchase=0, delivered=8, estimated=5),        # late by 3 days
            order("o3", delivered=None),                              # delivered, no date: null wait
            order("o4", status="shipped"),                            # not delivered
            order("o5", purchase=0, delivered=5, estimated=5),        # exactly on time: delay 0
        ],
        order_items=[
            item("o1", 1, "p1", "s1", price=10.0, freight=2.0),
            item("o1", 2, "p1", "s2", price=5.0, freight=1.0),        # two sellers in one order
            item("o2", 1, "p2", None, price=None, freight=None),      # missing seller, missing money
            item("o3", 1, "p2", "s1"),
            item("o5", 1, "p1", "s1"),
            item(None, 1, "p3", "s1"),                                # missing key
        ],
        order_reviews=[
            ("r1", "o1", 5), ("r2", "o1", 1),                          # two reviews of one order
            ("r3", "o2", 3), ("r4", "o5", None),                       # missing score
        ],
        customers=[("c1", "z1")],
        sellers=[("s1", "z1", "city1", "st1"), ("s2", "z2", "city2", "st2")],
        geolocation=[
            (3, "z1", -23.0, -46.0), (1, "z1", -22.0, -43.0),         # file order: ordinal 1 first
            (2, "z2", -25.0, -49.0),
        ],
    )


def test_wait_time_clamps_and_keeps_missing(tables):
    r = rows(O.order_wait_time(tables))
    assert set(r) == {"o1", "o2", "o3", "o5"}
    assert r["o1"]["wait_time"] == 3.0 and r["o1"]["expected_wait_time"] == 5.0
    assert r["o1"]["delay_vs_expected"] == 0.0
    assert r["o2"]["delay_vs_expected"] == 3.0
    assert r["o5"]["delay_vs_expected"] == 0.0
    assert r["o3"]["wait_time"] is None and r["o3"]["delay_vs_expected"] is None


def test_is_delivered_false_keeps_all_statuses(tables):
    assert O.order_wait_time(tables, is_delivered=False).count() == 5


def test_review_flags_missing_score_is_zero(tables):
    got = {(r["order_id"], r["review_score"]): (r["dim_is_five_star"], r["dim_is_one_star"])
           for r in O.order_review_score(tables).collect()}
    assert got[("o1", 5)] == (1, 0) and got[("o1", 1)] == (0, 1)
    assert got[("o5", None)] == (0, 0)


def test_item_stats_counts_rows_and_drops_null_key(tables):
    r = rows(O.order_item_stats(tables))
    assert None not in r
    assert r["o1"]["number_of_products"] == 2 and r["o1"]["number_of_sellers"] == 2
    # missing seller not counted; sums over only-missing values are 0
    assert r["o2"]["number_of_products"] == 1 and r["o2"]["number_of_sellers"] == 0
    assert r["o2"]["price"] == 0.0 and r["o2"]["freight_value"] == 0.0
    assert r["o1"]["price"] == 15.0


def test_distinct_sellers_option(spark):
    t = make_tables(spark, order_items=[item("o1", 1, "p1", "s1"), item("o1", 2, "p2", "s1")])
    assert O.order_number_sellers(t).first()["number_of_sellers"] == 2
    assert O.order_number_sellers(t, distinct_sellers=True).first()["number_of_sellers"] == 1


def test_first_location_in_file_order(tables):
    geo = {r["zip"]: (r["lat"], r["lng"]) for r in O.first_location_by_zip(tables).collect()}
    assert geo["z1"] == (-22.0, -43.0)


def test_distance_mean_over_items(tables):
    d = rows(O.order_distance(tables))
    # o1: item 1 seller in z1 (same place as customer) = 0 km, item 2 from z2
    # z2 lies 6 degrees west and 3 south; by the spherical law of cosines
    angle = math.acos(math.sin(math.radians(-22)) * math.sin(math.radians(-25))
                      + math.cos(math.radians(-22)) * math.cos(math.radians(-25)) * math.cos(math.radians(6)))
    assert d["o1"]["distance_seller_customer"] == pytest.approx(6371 * angle / 2, rel=1e-9)
    assert "o2" not in d  # its only item has no seller


def test_training_duplicates_reviews_and_drops_missing(tables):
    t = O.order_training(tables)
    assert t.columns == O.TRAINING_COLUMNS
    got = sorted((r["order_id"], r["review_score"]) for r in t.collect())
    # o1 twice (two reviews), o2 has no distance, o3 no wait, o5 no score
    assert got == [("o1", 1), ("o1", 5)]


def test_training_without_distance(tables):
    t = O.order_training(tables, with_distance_seller_customer=False)
    assert "distance_seller_customer" not in t.columns
    assert sorted(r["order_id"] for r in t.collect()) == ["o1", "o1", "o2"]


def test_training_fixture_shapes(sf001, sf01):
    # row counts of the supplied mapping (see FIXTURES.md)
    assert O.order_training(sf001).count() == 1016
    assert O.order_training(sf01).count() == 9972
    assert O.order_training(sf01, with_distance_seller_customer=False).count() == 9972


def test_days_are_24h_in_any_session_zone(spark):
    """A wait across a daylight-saving change is still a whole number of days."""
    from mercato.functions.exprs import avg_months_between, days_between

    df = spark.sql(
        "select timestamp_ntz'2017-10-14 12:00:00' as a, timestamp_ntz'2017-10-16 12:00:00.5' as b, "
        "timestamp_ntz'2018-02-17 00:00:00' as c, timestamp_ntz'2018-02-18 00:00:00' as d"
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Sao_Paulo", "UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(days_between("a", "b").alias("x"), days_between("c", "d").alias("y"),
                          avg_months_between("a", "b").alias("m")).first()
            assert r["x"] == 172800500000 / 86400e6
            assert r["y"] == 1.0
            assert r["m"] == 172800500000 / 2629746e6
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_keys_never_join(spark):
    """Rows whose key is missing on both sides do not match (keys are non-null by contract)."""
    t = make_tables(
        spark,
        orders=[order(None), order("o1")],
        order_items=[item(None, 1, "p1", "s1"), item("o1", 1, "p1", "s1")],
        order_reviews=[("r0", None, 5), ("r1", "o1", 4)],
        customers=[("c1", "z1")],
        sellers=[("s1", "z1", "c", "s")],
        geolocation=[(1, "z1", -23.0, -46.0)],
    )
    got = O.order_training(t).collect()
    assert [(r["order_id"], r["review_score"]) for r in got] == [("o1", 4)]
    assert [r["order_id"] for r in O.order_distance(t).collect()] == ["o1"]


def test_a_hot_zip_and_seller_without_broadcast(spark):
    """A third of the orders on one zip and of the items on one seller, joined without broadcasting."""
    orders = spark.range(3000).selectExpr("concat('o', id) as order_id", "concat('c', if(id % 3 = 0, 0, id)) as customer_id")
    items = spark.range(3000).selectExpr("concat('o', id) as order_id", "1 as order_item_id", "'p' as product_id", "concat('s', if(id % 3 = 1, 0, id % 50)) as seller_id")
    t = make_tables(spark, customers=[(f"c{k}", f"z{k % 40}") for k in range(3000)], sellers=[(f"s{k}", f"z{k % 40}", "c", "s") for k in range(50)],
                    geolocation=[(k, f"z{k}", -20.0 - k / 10, -40.0) for k in range(40)]) | {"orders": orders, "order_items": items}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = {r["order_id"]: r["distance_seller_customer"] for r in O.order_distance(t).collect()}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = {r["order_id"]: r["distance_seller_customer"] for r in O.order_distance(t).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want and len(got) == 3000
    one = 6371 * math.pi / 180 / 10  # km between neighbouring zips
    assert got["o1"] == pytest.approx(abs(1 - 0) * one, rel=1e-6)
