import pytest
from helpers import item, make_tables, order, ts

from mercato.operators import products as P
from mercato.operators import sellers as S


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(
        spark,
        orders=[
            order("o1", purchase=0, approved=0, carrier=4, delivered=6),
            order("o2", purchase=0, approved=20, carrier=1, delivered=2),
            order("o3", status="shipped", approved=40, carrier=None, delivered=None),
            order("o4", approved=None, carrier=None, delivered=None),
        ],
        order_items=[
            item("o1", 1, "p1", "s1", limit=2),   # 2 days late to the carrier
            item("o1", 2, "p1", "s1", limit=2),
            item("o2", 1, "p2", "s1", limit=3),   # 2 days early
            item("o3", 1, "p1", "s2", limit=1),
            item("o4", 1, "p2", "s3", limit=1),   # only a delivered order with no carrier date
        ],
        order_reviews=[("r1", "o1", 5), ("r2", "o2", 1), ("r3", "o3", 3)],
        sellers=[("s1", "z1", "a", "x"), ("s1", "z1", "b", "x"), ("s2", "z2", "c", "y"), ("s3", "z1", "d", "x")],
        products=[("p1", "cat", 1, 2, 3, 4, 5, 6, 7), ("p2", None, 1, 2, 3, 4, 5, 6, 7)],
        product_category_name_translation=[("cat", "category_en")],
    )


def test_seller_listed_with_two_cities_stays_twice(tables):
    feats = S.seller_features(tables).collect()
    assert sorted((r["seller_id"], r["seller_city"]) for r in feats) == [("s1", "a"), ("s1", "b"), ("s2", "c"), ("s3", "d")]


def test_delay_is_item_weighted_then_clamped(tables):
    d = by(S.seller_delay_wait(tables), "seller_id")
    # s1 items: +2, +2, -2 days -> mean 2/3
    assert d["s1"]["delay_to_carrier"] == pytest.approx(2 / 3)
    assert d["s1"]["wait_time"] == pytest.approx((6 + 6 + 2) / 3)
    assert "s2" not in d  # no delivered order
    # s3: delivered order without a carrier date -> mean missing -> 0
    assert d["s3"]["delay_to_carrier"] == 0.0 and d["s3"]["wait_time"] is None


def test_delay_clamps_negative_mean(spark):
    t = make_tables(spark, orders=[order("o1", carrier=1)], order_items=[item("o1", 1, "p", "s", limit=5)])
    assert S.seller_delay_wait(t).first()["delay_to_carrier"] == 0.0


def test_active_dates_and_half_even_months(tables, spark):
    d = by(S.seller_active_dates(tables), "seller_id")
    assert d["s1"]["date_first_sale"] == ts(0) and d["s1"]["date_last_sale"] == ts(20)
    assert d["s1"]["months_on_olist"] == 1.0  # 20 / 30.44 = 0.66 -> 1
    assert "s3" not in d  # its order was never approved
    # 1.5 average months rounds to 2, 2.5 to 2 (half to even)
    from datetime import timedelta
    for months, want in ((1.5, 2.0), (2.5, 2.0), (0.5, 0.0)):
        t = make_tables(
            spark,
            orders=[order("a", approved=0), ("b", "c1", "delivered", ts(0), ts(0) + timedelta(seconds=2629746 * months), None, None, None)],
            order_items=[item("a", 1, "p", "s"), item("b", 1, "p", "s")],
        )
        assert S.seller_active_dates(t).first()["months_on_olist"] == want


def test_quantity_counts_items_and_distinct_orders(tables):
    q = by(S.seller_quantity(tables), "seller_id")
    assert (q["s1"]["n_orders"], q["s1"]["quantity"]) == (2, 3)
    assert q["s1"]["quantity_per_order"] == 1.5


def test_review_score_over_distinct_order_seller_pairs(tables):
    r = by(S.seller_review_score(tables), "seller_id")
    # s1: o1 (5) once despite two items, o2 (1)
    assert r["s1"]["review_score"] == 3.0
    assert r["s1"]["share_of_five_stars"] == 0.5 and r["s1"]["share_of_one_stars"] == 0.5


def test_review_costs_and_profits(spark):
    t = make_tables(spark, order_items=[item("o1", 1, "p", "s1"), item("o2", 1, "p", "s1")])
    training = spark.createDataFrame([("o1", 3), ("o1", 2), ("o2", 1)], "order_id string, review_score int")
    c = S.seller_review_costs(t, orders=training).first()
    assert c["review_costs"] == 40 + 50 + 100


def test_profits_on_fixture(sf001, sf01):
    p1 = S.seller_profits(sf001).collect()
    assert len(p1) == 10
    p2 = S.seller_profits(sf01).collect()
    assert len(p2) == 100 and sum(r["profits"] < 0 for r in p2) == 5
    assert S.seller_training(sf01).count() == 100
    assert len(S.seller_training(sf01).columns) == 18


def test_product_features_and_training(tables, sf01):
    f = P.product_features(tables).collect()
    assert [r["product_id"] for r in f] == ["p1"]
    assert "product_name_length" in P.product_features(tables).columns
    assert P.product_training(sf01).count() == 2000


def test_product_wait_counts_each_order_once(tables):
    w = by(P.product_wait_time(tables), "product_id")
    # p1 is in o1 twice (wait 6) and in undelivered o3 -> mean 6
    assert w["p1"]["wait_time"] == 6.0
    s = by(P.product_item_stats(tables), "product_id")
    assert (s["p1"]["n_orders"], s["p1"]["quantity"], s["p1"]["sales"]) == (2, 3, 30.0)


def test_duplicated_order_rows_keep_their_weight(spark):
    """An order listed twice counts twice in the delay and wait means (as a
    row-wise join does) but its items are counted once in quantities and sales."""
    t = make_tables(
        spark,
        orders=[order("o1", carrier=4, delivered=6), order("o1", carrier=2, delivered=3),
                order("o2", carrier=1, delivered=2)],
        order_items=[item("o1", 1, "p", "s", limit=2, price=10.0), item("o2", 1, "p", "s", limit=2, price=5.0)],
    )
    d = S.seller_delay_wait(t).first()
    # item of o1 meets two order rows: delays 2 and 0; item of o2: -1  -> mean 1/3
    assert d["delay_to_carrier"] == pytest.approx(1 / 3)
    assert d["wait_time"] == pytest.approx((6 + 3 + 2) / 3)
    q = S.seller_item_stats(t).first()
    assert (q["n_orders"], q["quantity"], q["sales"]) == (2, 2, 15.0)
