"""Adapter from the star-schema test tables to the order tables.

Those tables hold no payments, reviews or delivery dates, so the adapter derives
stand-ins from columns they do have; all are plain functions of one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.contracts import OrderTables

# The source's code of a finished order, and how its flags read as payment types.
DELIVERED = "F"
PAYMENT_TYPE = {"R": "voucher", "A": "credit_card", "N": "boleto"}
UNMAPPED_REGION = "MIDDLE EAST"
UNTRANSLATED_TYPE = "STANDARD"

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _decode(column: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in mapping.items())
    return f"CASE {column} {cases} END"


LINES = (
    "l_orderkey AS order_id", "l_linenumber AS order_item_id", "l_partkey AS product_id",
    "l_extendedprice AS price", "l_extendedprice * l_tax AS freight_value",
    _decode("l_returnflag", PAYMENT_TYPE) + " AS payment_type",
    "l_linenumber AS payment_installments",
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value",
    "CASE WHEN l_returnflag <> 'N' THEN CAST(1 + l_suppkey % 5 AS INT) END AS review_score")
TRANSIT = "CAST(1 + (o_orderkey * 7 + o_custkey) % 30 AS INT)"
PROMISED = "10 + 3 * CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT)"
ORDERS = (
    "o_orderkey AS order_id", "o_custkey AS customer_id",
    "o_orderstatus AS order_status",
    "o_orderdate AS order_purchase_timestamp",
    f"CASE WHEN o_orderkey % 53 <> 0 THEN TIMESTAMPADD(DAY, {TRANSIT}, o_orderdate) END "
    "AS order_delivered_customer_date",
    f"TIMESTAMPADD(DAY, {PROMISED}, o_orderdate) AS order_estimated_delivery_date")


def star_tables(spark: SparkSession, folder: str) -> OrderTables:
    """Order tables read from the star-schema Parquet files in ``folder``."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    orders = table("orders").selectExpr(*ORDERS)
    nation = table("nation")
    customers = (table("customer")
                 .join(nation, F.expr("c_nationkey = n_nationkey"), "left")
                 .selectExpr("c_custkey AS customer_id", "c_custkey AS customer_unique_id",
                             "n_name AS customer_state"))
    regions = (nation
               .join(table("region"), F.expr("n_regionkey = r_regionkey"))
               .filter(f"r_name <> '{UNMAPPED_REGION}'")
               .selectExpr("n_name AS customer_state", "r_name AS region"))
    part = table("part")
    products = part.selectExpr(
        "p_partkey AS product_id", "CASE WHEN p_size <> 25 THEN p_type END AS product_category_name")
    categories = (part.selectExpr("p_type AS product_category_name").distinct()
                  .filter(f"product_category_name <> '{UNTRANSLATED_TYPE}'")
                  .selectExpr("*", "LOWER(product_category_name) AS product_category_name_english"))
    lines = table("lineitem").selectExpr(*LINES)
    return OrderTables(
        orders=orders,
        customers=customers,
        items=lines.select("order_id", "order_item_id", "product_id", "price", "freight_value"),
        payments=lines.select("order_id", "payment_type", "payment_installments", "payment_value"),
        reviews=lines.filter("review_score IS NOT NULL").select("order_id", "review_score"),
        products=products,
        categories=categories,
        regions=regions,
        lines=lines,
        delivered=DELIVERED,
    )
