import os
import tempfile

import pytest

from mercato.sources.csv_tables import load_tables, table_key

BOM = "﻿"

CSV = {
    "olist_orders_dataset.csv": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 10:00:00,2018-01-04 10:00:00,2018-01-10 00:00:00\n"
    "o2,c2,shipped,2018-01-02 10:00:00,NA,,,2018-01-10 00:00:00\n",
    "olist_geolocation_dataset.csv": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    "01046,-23.5,-46.6,sao paulo,SP\n01046,-23.6,-46.7,sao paulo,SP\n",
    "olist_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2018-01-03 00:00:00,10.5,NaN\n",
    "product_category_name_translation.csv": "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n",
    "notes.txt": "not a table\n",
}


def test_table_key():
    assert table_key("/x/olist_order_items_dataset.csv") == "order_items"
    assert table_key("product_category_name_translation.csv") == "product_category_name_translation"


def test_csv_loader(spark):
    d = tempfile.mkdtemp(prefix="mercato-csv-")
    for name, text in CSV.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(BOM + text)
    t = load_tables(spark, d)
    assert set(t) == {"orders", "geolocation", "order_items", "product_category_name_translation"}
    o = {r["order_id"]: r for r in t["orders"].collect()}
    assert o["o2"]["order_approved_at"] is None and o["o2"]["order_delivered_customer_date"] is None
    assert str(o["o1"]["order_purchase_timestamp"]) == "2018-01-01 10:00:00"
    assert dict(t["orders"].dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    tr = t["product_category_name_translation"].collect()
    assert tr[0]["product_category_name"] == "beleza_saude"  # BOM stripped from the header
    g = t["geolocation"].collect()
    assert g[0]["geolocation_zip_code_prefix"] == "01046"  # zeros kept
    from mercato.operators.orders import first_location_by_zip

    first = first_location_by_zip(t).first()
    assert (first["lat"], first["lng"]) == (-23.5, -46.6)
    assert t["order_items"].first()["freight_value"] is None  # NaN token is missing


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 1016
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert "order_training" in o


def test_first_location_survives_many_splits(spark):
    """File order is kept when the geolocation file is read as several splits."""
    d = tempfile.mkdtemp(prefix="mercato-geo-")
    header = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    lines, first = [], {}
    for i in range(6000):
        z = f"{(i * 7919) % 97:05d}"
        lat, lng = -20.0 - i * 1e-4, -40.0 - i * 1e-4
        first.setdefault(z, (round(lat, 6), round(lng, 6)))
        lines.append(f"{z},{lat:.6f},{lng:.6f},city,ST\n")
    with open(os.path.join(d, "olist_geolocation_dataset.csv"), "w") as f:
        f.write(header + "".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        t = load_tables(spark, d)
        assert t["geolocation"].rdd.getNumPartitions() > 4
        from mercato.operators.orders import first_location_by_zip

        got = {r["zip"]: (r["lat"], r["lng"]) for r in first_location_by_zip(t).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == first


def test_register_views(spark):
    from mercato.sources.csv_tables import register_views

    register_views({"mercato_view_test": spark.range(3)})
    assert spark.sql("select count(*) as n from mercato_view_test").first()["n"] == 3


def test_csv_export_read_back_matches_the_parquet_fixture(spark):
    from mercato.operators.orders import order_training
    from mercato.sources.fixture import fixture_tables

    d = tempfile.mkdtemp(prefix="mercato-export-")
    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    for name, df in tables.items():
        if name == "geolocation":
            df = df.orderBy("ordinal").drop("ordinal")
        df.coalesce(1).write.option("header", True).csv(f"{d}/{name}.csv")
    t = load_tables(spark, d)
    assert dict(t["orders"].dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    columns = ["order_id", "review_score", "wait_time", "distance_seller_customer"]
    g, w = (sorted((str(r[0]), *r[1:]) for r in order_training(x).select(*columns).collect()) for x in (t, tables))
    assert [x[:3] for x in g] == [x[:3] for x in w]
    # the mean over an order's items may be summed in another order
    assert [x[3] for x in g] == pytest.approx([x[3] for x in w], rel=1e-12)


def write_csv(name, text):
    d = tempfile.mkdtemp(prefix="mercato-csv-")
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)
    return d


@pytest.mark.parametrize("spelling, want", [
    ("2018-01-01", "2018-01-01 00:00:00"), ("2018-01-01 10:00:00", "2018-01-01 10:00:00"),
    ("2018-01-01 10:00:00.5", "2018-01-01 10:00:00.500000"), ("2018-01-01T10:00:00", "2018-01-01 10:00:00"),
])
def test_timestamp_spellings(spark, spelling, want):
    d = write_csv("orders.csv", f"order_id,order_approved_at\no1,{spelling}\n")
    assert str(load_tables(spark, d)["orders"].first()["order_approved_at"]) == want


@pytest.mark.parametrize("column, value", [("order_approved_at", "soon"), ("order_approved_at", "01/02/2018")])
def test_an_unreadable_timestamp_fails_and_is_named(spark, column, value):
    d = write_csv("orders.csv", f"order_id,{column}\no1,{value}\n")
    with pytest.raises(Exception, match=f"column {column}: not a timestamp_ntz: {value}"):
        load_tables(spark, d)["orders"].collect()


@pytest.mark.parametrize("value", ['"1,200.50"', "R$5", " NA"])
def test_an_unreadable_number_fails(spark, value):
    d = write_csv("order_items.csv", f"order_id,price\no1,{value}\n")
    with pytest.raises(Exception, match="column price: not a double"):
        load_tables(spark, d)["order_items"].collect()


def test_a_missing_folder_raises(spark):
    with pytest.raises(FileNotFoundError):
        load_tables(spark, tempfile.mkdtemp(prefix="mercato-empty-"))
    with pytest.raises(FileNotFoundError):
        load_tables(spark, "/no/such/folder")


def test_the_profile_of_loaded_tables_shows_a_wrong_type(spark):
    """Tables written as CSV come back with their types, over many splits, too; a column read as another type changes its row."""
    from mercato.registry import table_profile
    from mercato.sources import csv_tables
    from mercato.sources.fixture import fixture_tables

    d = tempfile.mkdtemp(prefix="mercato-roundtrip-")
    csv_tables.write_tables(fixture_tables(spark, "/root/testdata/sf0.001"), d)
    rows = lambda: {(r["table"], r["column"]): (r["type"], r["rows"], r["nulls"], round(r["checksum"], 4)) for r in table_profile(load_tables(spark, d)).collect()}
    whole = rows()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert rows() == whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert whole["order_items", "price"][0] == "double" and whole["orders", "order_purchase_timestamp"][0] == "timestamp_ntz"
    declared = csv_tables.SCHEMAS["order_items"]
    original = declared["price"]
    try:
        declared["price"] = declared["product_id"]
        assert rows()["order_items", "price"] != whole["order_items", "price"]
    finally:
        declared["price"] = original
