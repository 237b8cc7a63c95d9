import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.sources import files, replicate
from orderlens.sources.contracts import CATEGORIES, ORDERS


def test_csv_with_bom_extra_columns_and_types(spark, tmp_path):
    path = tmp_path / "categories.csv"
    path.write_bytes("﻿product_category_name,note,product_category_name_english\n"
                     "beleza,x,beauty\n".encode())
    df = files.read_csv(spark, str(path), CATEGORIES)
    assert df.columns == CATEGORIES.names
    assert [tuple(r) for r in df.collect()] == [("beleza", "beauty")]

    path = tmp_path / "orders.csv"
    path.write_text("order_id,customer_id,order_status,order_purchase_timestamp,"
                    "order_delivered_customer_date,order_estimated_delivery_date\n"
                    "o1,k1,delivered,2017-10-02 10:56:33,,2017-10-18 00:00:00\n")
    row = files.read_csv(spark, str(path), ORDERS).first()
    assert row["order_purchase_timestamp"] == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert row["order_delivered_customer_date"] is None


def test_sinks_and_optional_tables(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.col("id") / 2)
    assert files.load_if_present(spark, str(tmp_path / "none")) is None
    files.write_parquet(df, str(tmp_path / "p"))
    assert files.load_if_present(spark, str(tmp_path / "p")).count() == 5
    files.write_csv(df, str(tmp_path / "c"), single_file=True)
    back = files.load_if_present(spark, str(tmp_path / "c"), "csv", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_order_tables_from_csv(spark, tmp_path):
    rows = {
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp,"
                  "order_delivered_customer_date,order_estimated_delivery_date\n"
                  "o,k,delivered,2017-10-02 10:56:33,2017-10-05 10:00:00,2017-10-18 00:00:00\n",
        "customers": "customer_id,customer_unique_id,customer_state\nk,u,SP\n",
        "items": "order_id,order_item_id,product_id,price,freight_value\no,1,p,10.5,2.0\n",
        "payments": "order_id,payment_type,payment_installments,payment_value\no,voucher,2,12.5\n",
        "reviews": "order_id,review_score\no,4\n",
        "products": "product_id,product_category_name\np,beleza\n",
        "categories": "product_category_name,product_category_name_english\nbeleza,beauty\n",
    }
    paths = {}
    for name, text in rows.items():
        (tmp_path / f"{name}.csv").write_text(text)
        paths[name] = str(tmp_path / f"{name}.csv")
    from orderlens import Settings
    from orderlens.operators import customers, facts
    t = files.read_order_tables(spark, paths)
    row = facts.order_facts(t).first()
    assert (row["customer_unique_id"], row["payment_value"], row["used_voucher"]) == ("u", 12.5, 1)
    feats = customers.first_order_features(facts.order_facts(t), t.regions, Settings()).first()
    assert (feats["region"], feats["delivery_days"], feats["delay_days"]) == (
        "Southeast", 3.0, -13.0)


def test_replicate_gives_each_copy_its_own_ids(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    got = replicate.replicate(df, 3, ["id"])
    assert sorted(r["id"] for r in got.collect()) == ["a_0", "a_1", "a_2", "b_0", "b_1", "b_2"]
    label = spark.createDataFrame([("×10",)], "s string")
    assert label.select(replicate.scale_factor("s")).first()[0] == 10


def test_stage_keeps_rows_and_needs_a_shared_folder(spark, monkeypatch):
    df = spark.range(10).withColumn("r", F.rand())
    staged = stages.stage(df)
    assert staged.collect() == staged.collect()

    class Remote:
        class conf:
            get = staticmethod(lambda *_: "file:/tmp/stages")

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        stages.shared_folder(Remote)
