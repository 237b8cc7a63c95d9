"""Standard SQL for the registered queries, over the same star-schema tables.

``BLOCKS`` are named sub-queries that may use earlier ones; ``sql`` puts the
ones a statement mentions in front of it.
"""

from __future__ import annotations

import re

from orderlens.functions.buckets import DELAY_BUCKETS, DELIVERY_BUCKETS, REVIEW_BUCKETS
from orderlens.operators.attribution import feature_names
from orderlens.operators.decide import CHECKS
from orderlens.operators.models import PLAIN_FEATURES
from orderlens.plans.queries import (
    BREAK_EVEN, COPIES, EXPERIENCE_FEATURES, RANKED_FEATURES, REGIONS, SAMPLE, STAR)

DAYS = STAR.churn_days


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"CASE WHEN COUNT({x}) > 0 THEN {money(x)} / COUNT({x}) END"


def rate(condition: str, over: str = "TRUE") -> str:
    """Share of ``condition`` among the rows where it is not null and ``over`` holds."""
    seen = f"SUM(CASE WHEN {over} AND ({condition}) IS NOT NULL THEN 1 ELSE 0 END)"
    hit = f"SUM(CASE WHEN {over} AND ({condition}) THEN 1 ELSE 0 END)"
    return f"CASE WHEN {seen} > 0 THEN CAST({hit} AS DOUBLE) / CAST({seen} AS DOUBLE) END"


def count_of(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def even(x: str, digits: int) -> str:
    scale = 10.0 ** digits
    return f"round_even(({x}) * {scale}, 0) / {scale}"


def days_between(later: str, earlier: str) -> str:
    return f"(CAST({later} AS DATE) - CAST({earlier} AS DATE))"


def segment(frequency: str, recency: str) -> str:
    return (f"CASE WHEN {frequency} > {STAR.repeat_frequency} THEN 'Repeat Buyers' "
            f"WHEN {recency} > {STAR.lost_recency} THEN 'Lost Customers' "
            f"WHEN {recency} < {STAR.recent_recency} THEN 'Recent Buyers' "
            f"ELSE 'At-Risk Buyers' END")


GROUP_MEASURES = f"""
  COUNT(*) AS Customers, {money('churn')} AS Churned, {rate('churn = 1')} AS Churn_Rate,
  {count_of('mature')} AS Mature_Customers, {rate('repeat_180 = 1', 'mature')} AS Repeat180_Mature,
  {money('Monetary')} AS Revenue, {mean('Monetary')} AS Avg_Monetary,
  {mean('avg_review_score')} AS Avg_Review, {mean('delivery_days')} AS Avg_Delivery_Days,
  {rate('delay_days > 0')} AS Late_Rate"""

TEST_BLOCK = """
SELECT Dimension, Groups, N, chi2, dof, P,
  CASE WHEN chi2 = 0 THEN 1.0 ELSE 1 - list_sum([
    exp((i + dof / 2.0) * ln(chi2 / 2) - chi2 / 2 - lgamma(i + dof / 2.0 + 1))
    for i in range(0, 2000)]) END AS p_value
FROM (
  SELECT Dimension, COUNT(*) AS Groups, CAST(SUM(n) AS BIGINT) AS N, MAX(pos) AS P,
    CAST(COUNT(*) - 1 AS INTEGER) AS dof,
    SUM(POWER(ABS(hits - n * pos / total) - least(slack, ABS(hits - n * pos / total)), 2)
        / (n * pos / total)
      + POWER(ABS(n - hits - n * (total - pos) / total)
              - least(slack, ABS(n - hits - n * (total - pos) / total)), 2)
        / (n * (total - pos) / total)) AS chi2
  FROM (
    SELECT *, CAST(SUM(n) OVER w AS DOUBLE) AS total, CAST(SUM(hits) OVER w AS DOUBLE) AS pos,
      CASE WHEN COUNT(*) OVER w = 2 THEN 0.5 ELSE 0.0 END AS slack
    FROM {counts} WHERE n >= {minimum}
    WINDOW w AS (PARTITION BY Dimension))
  GROUP BY Dimension)"""

TEST_COLUMNS = """Dimension, Groups, N, ROUND(chi2, 8) AS Chi2, dof, ROUND(p_value, 8) AS p_value,
  ROUND(SQRT(chi2 / N), 8) AS Cramers_V,
  CASE WHEN SQRT(chi2 / N) < 0.1 THEN 'weak' WHEN SQRT(chi2 / N) < 0.3 THEN 'medium'
       WHEN SQRT(chi2 / N) >= 0.3 THEN 'strong' END AS Effect"""

BLOCKS = {
    "lines": """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
  l_extendedprice AS price, l_extendedprice * l_tax AS freight_value,
  CASE l_returnflag WHEN 'R' THEN 'voucher' WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' END
    AS payment_type,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value,
  CASE WHEN l_returnflag <> 'N' THEN 1 + l_suppkey % 5 END AS review_score
FROM lineitem""",
    "order_dim": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  o_orderstatus AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 53 <> 0
       THEN o_orderdate + to_days(CAST(1 + (o_orderkey * 7 + o_custkey) % 30 AS INTEGER)) END
    AS order_delivered_customer_date,
  o_orderdate + to_days(10 + 3 * CAST(substring(o_orderpriority, 1, 1) AS INTEGER))
    AS order_estimated_delivery_date
FROM orders""",
    "customer_dim": """
SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, n_name AS customer_state
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "region_dim": """
SELECT n_name AS customer_state, r_name AS region FROM nation
JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'""",
    "product_dim": """
SELECT p_partkey AS product_id,
  CASE WHEN p_size <> 25 AND p_type <> 'STANDARD' THEN lower(p_type) END AS category
FROM part""",
    "measures": f"""
SELECT order_id, {money('price')} AS total_price, {money('freight_value')} AS total_freight,
  COUNT(*) AS item_count, {money('payment_value')} AS payment_value,
  MAX(order_item_id) AS max_installments,
  MAX(CASE WHEN payment_type = 'voucher' THEN 1 ELSE 0 END) AS used_voucher,
  AVG(review_score) AS avg_review_score
FROM lines GROUP BY order_id""",
    "facts": """
SELECT o.customer_id, o.order_id, o.order_status, o.order_purchase_timestamp,
  o.order_delivered_customer_date, o.order_estimated_delivery_date,
  m.* EXCLUDE (order_id), c.customer_unique_id, c.customer_state
FROM order_dim o JOIN measures m ON o.order_id = m.order_id
LEFT JOIN customer_dim c ON o.customer_id = c.customer_id
WHERE o.order_status = 'F' AND o.order_purchase_timestamp IS NOT NULL
  AND m.payment_value IS NOT NULL""",
    "span": """
SELECT MIN(CAST(order_purchase_timestamp AS DATE)) AS lo,
  MAX(CAST(order_purchase_timestamp AS DATE)) AS hi FROM facts""",
    "rfm_t": f"""
SELECT customer_unique_id,
  CAST(MAX(hi) + 1 - CAST(MAX(order_purchase_timestamp) AS DATE) AS INTEGER) AS Recency,
  COUNT(order_id) AS Frequency, {money('payment_value')} AS Monetary
FROM facts, span GROUP BY customer_unique_id HAVING {money('payment_value')} > 0""",
    "labelled": f"""
SELECT *, CASE WHEN Frequency = 1 AND Recency > {DAYS} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  AS churn FROM rfm_t""",
    "segmented": f"SELECT *, {segment('Frequency', 'Recency')} AS Segment_Label FROM rfm_t",
    "first_t": """
SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER w AS rn, LEAD(order_purchase_timestamp) OVER w AS next_ts
  FROM facts
  WINDOW w AS (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id))
WHERE rn = 1""",
    "features": f"""
SELECT customer_unique_id, order_id, f.customer_state, order_purchase_timestamp AS first_ts,
  CAST({days_between('order_purchase_timestamp', 'lo')} AS DOUBLE) AS first_day,
  CAST({days_between('next_ts', 'order_purchase_timestamp')} AS DOUBLE) AS days_to_second,
  ROUND(ln(1 + payment_value), 9) AS log_order_value,
  CAST(item_count AS DOUBLE) AS item_count,
  COALESCE(LEAST(total_freight / NULLIF(total_price, 0), {STAR.freight_cap}),
           {STAR.freight_cap}::DOUBLE) AS freight_ratio,
  avg_review_score,
  CASE WHEN avg_review_score IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_review,
  CAST({days_between('order_delivered_customer_date', 'order_purchase_timestamp')} AS DOUBLE)
    AS delivery_days,
  CAST({days_between('order_delivered_customer_date', 'order_estimated_delivery_date')} AS DOUBLE)
    AS delay_days,
  CAST(max_installments AS DOUBLE) AS max_installments,
  CAST(used_voucher AS DOUBLE) AS used_voucher,
  COALESCE(region, 'Other') AS region
FROM first_t f LEFT JOIN region_dim r ON f.customer_state = r.customer_state, span""",
    "outcomes": f"""
SELECT f.*, first_day <= (hi - lo) - {DAYS} AS mature,
  CASE WHEN days_to_second <= {DAYS} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS repeat_180
FROM features f, span""",
    "main_cat": """
SELECT order_id, COALESCE(category, 'unknown') AS category FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
    ORDER BY price DESC, order_item_id, product_id) AS rn FROM lines) i
LEFT JOIN product_dim p ON i.product_id = p.product_id WHERE rn = 1""",
    "cust": """
SELECT l.*, s.Segment_Label, o.* EXCLUDE (customer_unique_id),
  COALESCE(m.category, 'unknown') AS category
FROM labelled l JOIN segmented s ON l.customer_unique_id = s.customer_unique_id
JOIN outcomes o ON l.customer_unique_id = o.customer_unique_id
LEFT JOIN main_cat m ON o.order_id = m.order_id""",
    "by_state": f"SELECT customer_state, {GROUP_MEASURES} FROM cust GROUP BY customer_state",
    "by_category": f"SELECT category, {GROUP_MEASURES} FROM cust GROUP BY category",
    "by_segment": f"SELECT Segment_Label, {GROUP_MEASURES} FROM cust GROUP BY Segment_Label",
    "big_states":
        f"SELECT * FROM by_state WHERE Mature_Customers >= {STAR.min_state_mature}",
    "big_categories":
        f"SELECT * FROM by_category WHERE Mature_Customers >= {STAR.min_category_mature}",
    "bucketed": """
SELECT *,
  CASE WHEN delivery_days <= 7 THEN '<=7 days' WHEN delivery_days <= 14 THEN '8-14 days'
       WHEN delivery_days <= 21 THEN '15-21 days' ELSE '>21 days' END AS delivery,
  CASE WHEN delay_days IS NULL THEN NULL WHEN delay_days <= 0 THEN 'on time or early'
       WHEN delay_days <= 7 THEN '1-7 days late' ELSE '>7 days late' END AS delay,
  CASE WHEN avg_review_score IS NULL THEN 'no review'
       WHEN round_even(avg_review_score, 0) = 1 THEN '1 star'
       ELSE CAST(round_even(avg_review_score, 0) AS INTEGER) || ' stars' END AS review,
  CASE WHEN max_installments <= 0 OR max_installments > 100 THEN NULL
       WHEN max_installments <= 1 THEN '1' WHEN max_installments <= 3 THEN '2-3'
       WHEN max_installments <= 6 THEN '4-6' WHEN max_installments <= 10 THEN '7-10'
       ELSE '>10' END AS installments
FROM cust WHERE mature""",
    "observed": "SELECT * FROM bucketed WHERE delivery_days IS NOT NULL",
    "groups_long": """
SELECT 'delivery' AS Dimension, delivery AS Bucket, * FROM observed
UNION ALL SELECT 'delay', delay, * FROM observed WHERE delay IS NOT NULL
UNION ALL SELECT 'review', review, * FROM observed""",
    "bucket_list": "SELECT * FROM (VALUES " + ", ".join(
        f"('{d}', {i}, '{b}')" for d, names in (
            ("delivery", DELIVERY_BUCKETS), ("delay", DELAY_BUCKETS), ("review", REVIEW_BUCKETS))
        for i, b in enumerate(names, start=1)) + ") AS t(Dimension, Bucket_Order, Bucket)",
    "experience": f"""
SELECT b.Dimension, b.Bucket_Order, b.Bucket, g.Customers, Repeat180, Churn_Rate_Raw, Avg_Review
FROM bucket_list b LEFT JOIN (
  SELECT Dimension, Bucket, COUNT(*) AS Customers, {rate('repeat_180 = 1')} AS Repeat180,
    {rate('churn = 1')} AS Churn_Rate_Raw, {mean('avg_review_score')} AS Avg_Review
  FROM groups_long GROUP BY Dimension, Bucket) g
ON b.Dimension = g.Dimension AND b.Bucket = g.Bucket""",
    "test_counts": """
SELECT Dimension, Bucket, COUNT(*) AS n, SUM(CASE WHEN repeat_180 = 1 THEN 1 ELSE 0 END) AS hits
FROM (SELECT Dimension, Bucket, repeat_180 FROM groups_long
  UNION ALL SELECT 'state', customer_state, repeat_180 FROM observed
    WHERE customer_state IS NOT NULL
  UNION ALL SELECT 'category', category, repeat_180 FROM observed)
GROUP BY Dimension, Bucket""",
    "installment_counts": """
SELECT 'installments' AS Dimension, installments AS Bucket, COUNT(*) AS n,
  SUM(CASE WHEN repeat_180 = 1 THEN 1 ELSE 0 END) AS hits
FROM bucketed WHERE installments IS NOT NULL GROUP BY installments""",
    "tests": TEST_BLOCK.format(counts="test_counts", minimum=STAR.min_test_group),
    "installment_tests": TEST_BLOCK.format(counts="installment_counts", minimum=0),
    "installment_rates": f"""
SELECT installments AS Installments, COUNT(*) AS Customers, {rate('repeat_180 = 1')} AS Repeat180,
  CAST(array_position(['1', '2-3', '4-6', '7-10', '>10'], installments) AS INTEGER) AS Bin_Order
FROM bucketed WHERE installments IS NOT NULL GROUP BY installments""",
    "rates": f"""
SELECT COUNT(*) AS customers, {rate('churn = 1')} AS churn_rate,
  {count_of('mature')} AS mature_customers, {rate('repeat_180 = 1', 'mature')} AS repeat_rate
FROM cust""",
    "values_t": f"""
SELECT Segment_Label, COUNT(*) AS Customers, {money('Monetary')} AS Revenue,
  {mean('Monetary')} AS Mean_Monetary,
  ROUND(quantile_cont(Monetary, 0.25), 6) AS P25, ROUND(quantile_cont(Monetary, 0.5), 6) AS Median,
  ROUND(quantile_cont(Monetary, 0.75), 6) AS P75, ROUND(quantile_cont(Monetary, 0.95), 6) AS P95
FROM segmented GROUP BY Segment_Label""",
    "segment_values": f"""
SELECT *,
  {even("CAST(Customers AS DOUBLE) / CAST(SUM(Customers) OVER () AS DOUBLE) * 100.0", 1)}
    AS Customer_Share_pct,
  {even("Revenue / CAST(SUM(CAST(Revenue AS DECIMAL(18,6))) OVER () AS DOUBLE) * 100.0", 1)}
    AS Revenue_Share_pct,
  CAST(array_position(['Recent Buyers', 'At-Risk Buyers', 'Lost Customers', 'Repeat Buyers'],
    Segment_Label) AS INTEGER) AS Segment_Order
FROM values_t""",
    "economics": f"""
SELECT *, Revenue / Orders AS AOV FROM (
  SELECT Segment_Label, COUNT(*) AS Customers, {money('Monetary')} AS Revenue,
    CAST(SUM(Frequency) AS BIGINT) AS Orders FROM segmented GROUP BY Segment_Label)""",
    "uplifts": "SELECT * FROM (VALUES " + ", ".join(
        [f"(FALSE, {u}::DOUBLE)" for u in STAR.uplift_points]
        + [f"(TRUE, {u}::DOUBLE)" for u in STAR.uplift_spend]) + ") AS t(for_repeat, u)",
    "scenario_values": f"""
SELECT e.*, u, for_repeat, (SELECT {money('Revenue')} FROM economics) AS total,
  CASE WHEN for_repeat THEN Orders * u ELSE Customers * u END AS extra_orders,
  CASE WHEN for_repeat THEN Revenue * u ELSE Customers * u * AOV END AS extra_revenue,
  CASE WHEN for_repeat THEN Revenue * u / Customers ELSE u * AOV END AS break_even
FROM economics e JOIN uplifts x ON x.for_repeat = (e.Segment_Label = 'Repeat Buyers')""",
    "scenarios": f"""
SELECT Segment_Label,
  CASE WHEN for_repeat THEN '+' || CAST(CAST(round_even(u * 100, 0) AS INTEGER) AS VARCHAR)
       || '% spending' ELSE '+' || printf('%.1f', u * 100) || ' pp second order' END AS Uplift,
  u AS Uplift_Value, Customers AS Target_Customers,
  CAST(round_even(extra_orders, 0) AS BIGINT) AS Extra_Orders,
  CAST(round_even(extra_revenue, 0) AS BIGINT) AS Extra_Revenue,
  {even('extra_revenue / total * 100.0', 2)} AS Revenue_pct,
  {even('break_even', 2)} AS Break_Even_Per_Customer
FROM scenario_values""",
    "scored": """
SELECT customer_unique_id AS id, repeat_180 AS label,
  (item_count * 1000 + max_installments * 100 + COALESCE(delivery_days, 0)) / 10000.0::DOUBLE
    AS score
FROM outcomes WHERE mature""",
    "ranked": """
SELECT *, ROW_NUMBER() OVER (ORDER BY score DESC, id) AS r, COUNT(*) OVER () AS n,
  CAST(SUM(label) OVER () AS BIGINT) AS pos FROM scored""",
    "confusion": """
SELECT CAST(SUM(CASE WHEN label = 0 AND NOT hit THEN 1 ELSE 0 END) AS BIGINT) AS TN,
  CAST(SUM(CASE WHEN label = 0 AND hit THEN 1 ELSE 0 END) AS BIGINT) AS FP,
  CAST(SUM(CASE WHEN label = 1 AND NOT hit THEN 1 ELSE 0 END) AS BIGINT) AS FN,
  CAST(SUM(CASE WHEN label = 1 AND hit THEN 1 ELSE 0 END) AS BIGINT) AS TP
FROM (SELECT *, score >= (SELECT quantile_cont(score, 0.5) FROM scored) AS hit FROM scored)""",
    "confusion_measures": """
SELECT *, CAST(TP + TN AS DOUBLE) / (TN + FP + FN + TP) AS accuracy,
  CAST(TP AS DOUBLE) / greatest(TP + FP, 1) AS precision,
  CAST(TP AS DOUBLE) / greatest(TP + FN, 1) AS recall,
  ((TN + FP) * COALESCE(2.0::DOUBLE * TN / NULLIF(2.0::DOUBLE * TN + FN + FP, 0), 0)
   + (TP + FN) * COALESCE(2.0::DOUBLE * TP / NULLIF(2.0::DOUBLE * TP + FP + FN, 0), 0))
    / (TN + FP + FN + TP) AS f1_weighted
FROM confusion""",
    "deciles": f"""
SELECT CAST(bin AS INTEGER) AS Decile, COUNT(*) AS Customers,
  CAST(MAX(pos) AS DOUBLE) / MAX(n) AS Base_Rate, {rate('label = 1')} AS Repeat_Rate,
  {rate('label = 1')} / (CAST(MAX(pos) AS DOUBLE) / MAX(n)) AS Lift
FROM (SELECT *, greatest(1, ceil((r - 1) * 10 / greatest(n - 1, 1)::DOUBLE)) AS bin FROM ranked)
GROUP BY bin""",
    "roc_levels": """
SELECT *, ROW_NUMBER() OVER d AS i, LEAD(p) OVER d AS p_next, LEAD(q) OVER d AS q_next,
  SUM(p) OVER d AS tp, SUM(q) OVER d AS fp
FROM (SELECT score, SUM(label) AS p, SUM(1 - label) AS q FROM scored GROUP BY score)
WINDOW d AS (ORDER BY score DESC)""",
    "roc_kept": """
SELECT 0 AS place, 0 AS tp, 0 AS fp UNION ALL
SELECT ROW_NUMBER() OVER (ORDER BY score DESC), tp, fp FROM roc_levels
WHERE i = 1 OR p_next IS NULL OR p <> p_next OR q <> q_next""",
    "roc_places": """
SELECT DISTINCT CAST(CASE WHEN j = 299 THEN m ELSE floor(j * (m / 299.0::DOUBLE)) END AS BIGINT)
  AS place
FROM range(300) AS t(j), (SELECT MAX(place) AS m FROM roc_kept)""",
    "gain_places": """
SELECT DISTINCT CAST(CASE WHEN j = 299 THEN m ELSE floor(j * (m / 299.0::DOUBLE)) END AS BIGINT)
  AS place
FROM range(300) AS t(j), (SELECT COUNT(*) - 1 AS m FROM ranked)""",
}


def sql(statement: str) -> str:
    """``statement`` with the blocks it needs as a WITH clause."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(BLOCKS[name])

    visit(statement)
    parts = [f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + statement


def ntile(order: str, k: int = 5) -> str:
    return f"CAST(NTILE({k}) OVER (ORDER BY {order}, customer_unique_id) AS INTEGER)"


def quintile(column: str) -> str:
    place = f"(ROW_NUMBER() OVER (ORDER BY {column}, customer_unique_id) - 1)"
    return (f"CAST(greatest(1, ceil({place} * 5 / greatest(COUNT(*) OVER () - 1, 1)::DOUBLE)) - 1 "
            f"AS INTEGER)")


def draw(key: str) -> str:
    return f"CAST('0x' || substring(md5(CAST({key} AS VARCHAR) || '-{STAR.seed}'), 1, 8) AS BIGINT)"


SPLIT_LIMIT = int(STAR.train_share * 2 ** 32)
MEASURES = ("Recency", "Frequency", "Monetary")
IMPUTED = ("avg_review_score", "delivery_days", "delay_days", "freight_ratio", "max_installments")


def histogram(column: str) -> str:
    width = "((hi - lo) / 40.0::DOUBLE)"
    place = f"LEAST(39, COALESCE(floor((value - lo) / NULLIF({width}, 0)), 0))"
    return f"""
SELECT '{column}' AS metric, CAST(i AS INTEGER) AS bin, COALESCE(n, 0) AS customers, lo + i * {width} AS bin_start
FROM (SELECT CAST(MIN({column}) AS DOUBLE) AS lo, CAST(MAX({column}) AS DOUBLE) AS hi FROM rfm_t), range(40) AS t(i)
LEFT JOIN (SELECT CAST({place} AS BIGINT) AS bin, COUNT(*) AS n FROM (
  SELECT CAST({column} AS DOUBLE) AS value,
    CAST(MIN({column}) OVER () AS DOUBLE) AS lo, CAST(MAX({column}) OVER () AS DOUBLE) AS hi
  FROM rfm_t) GROUP BY 1) ON bin = i"""


def correlation(a: str, b: str, table: str = "big_states") -> str:
    def place(x: str) -> str:
        return f"RANK() OVER (ORDER BY {x}) + (COUNT(*) OVER (PARTITION BY {x}) - 1) / 2.0"

    return f"""
SELECT COUNT(*) AS groups, ROUND(corr(ra, rb), 9) AS rho FROM (
  SELECT {place('a')} AS ra, {place('b')} AS rb
  FROM (SELECT {a} AS a, {b} AS b FROM {table}) WHERE a IS NOT NULL AND b IS NOT NULL)"""


# Where each measure of the reconciliation checks comes from.
CHECK_VALUES = {
    "facts_orders": "SELECT COUNT(*) FROM facts",
    "facts_revenue": f"SELECT {money('payment_value')} FROM facts",
    "seg_customers": "SELECT COUNT(*) FROM segmented",
    "seg_orders": "SELECT SUM(Frequency) FROM segmented",
    "seg_revenue": f"SELECT {money('Monetary')} FROM segmented",
    "cust_customers": "SELECT COUNT(*) FROM cust",
    "cust_mature": f"SELECT {count_of('mature')} FROM cust",
    "cust_churned": f"SELECT {money('churn')} FROM cust",
    "items_revenue": f"SELECT {money('price + freight_value')} FROM lines "
                     "WHERE order_id IN (SELECT order_id FROM facts)",
}
for _name in ("segment", "state", "category"):
    CHECK_VALUES |= {
        f"by_{_name}_customers": f"SELECT SUM(Customers) FROM by_{_name}",
        f"by_{_name}_mature": f"SELECT SUM(Mature_Customers) FROM by_{_name}",
        f"by_{_name}_revenue": f"SELECT {money('Revenue')} FROM by_{_name}",
        f"by_{_name}_churned": f"SELECT {money('Churned')} FROM by_{_name}",
    }

BLOCKS["check_values"] = " UNION ALL ".join(
    f"SELECT {i} AS check_id, '{metric}' AS metric, '{a}' AS source_a, "
    f"CAST(({CHECK_VALUES[va]}) AS DOUBLE) AS value_a, '{b}' AS source_b, "
    f"CAST(({CHECK_VALUES[vb]}) AS DOUBLE) AS value_b"
    for i, (metric, a, va, b, vb, _) in enumerate(CHECKS, start=1))
_is_items = "source_b LIKE 'items%'"
BLOCKS["checks"] = f"""
SELECT *, {even('value_a - value_b', 2)} AS difference,
  abs(value_a - value_b) <= CASE WHEN {_is_items} THEN {STAR.source_gap} * value_b
    WHEN metric = 'revenue' THEN {STAR.money_tolerance} ELSE 0.0 END AS matched,
  CASE WHEN {_is_items} THEN {even('(value_a - value_b) / value_b * 100.0', 2)} END AS gap_pct
FROM check_values"""


def _values(numbers: tuple[float, ...], name: str) -> str:
    rows = ", ".join(f"({n}::DOUBLE)" for n in numbers)
    return f"(VALUES {rows}) AS {name}_t({name})"


def _fixed(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {even(x, digits)})"


def _pct(x: str, digits: int = 1) -> str:
    return f"{_fixed(f'({x}) * 100.0', digits)} || '%'"


def _one(query: str, digits: int, percent: bool = False) -> str:
    value = _pct(f"({query})", digits) if percent else _fixed(f"({query})", digits)
    return f"COALESCE({value}, 'n/a')"


_people = _pct("Customers / (SELECT SUM(Customers) FROM economics)::DOUBLE")
_revenue = _pct(f"Revenue / (SELECT {money('Revenue')} FROM economics)")
_shares = f"{_people} || ' of customers, ' || {_revenue} || ' of revenue'"
_bucket = "SELECT MAX(Repeat180) FROM experience WHERE Bucket = "

ACTIONS = f"""
SELECT e.Segment_Label AS Topic,
  CASE e.Segment_Label
    WHEN 'Recent Buyers' THEN {_shares} || '; best repeat categories: ' || COALESCE(
      (SELECT string_agg(category, ', ' ORDER BY category) FROM (
        SELECT category FROM big_categories ORDER BY Repeat180_Mature DESC, category LIMIT 2)),
      'none')
    WHEN 'Repeat Buyers' THEN {_shares} || '; spends R$' || {_fixed('Revenue / Customers', 0)}
      || ' per customer'
    ELSE {_shares} || '; order value R$' || {_fixed('AOV', 0)} END AS Evidence,
  CASE WHEN e.Segment_Label = 'Repeat Buyers' THEN 'orders per customer'
    ELSE 'second order within the window, base ' || {_pct('(SELECT repeat_rate FROM rates)')} END
    AS KPI,
  CASE WHEN e.Segment_Label = 'Repeat Buyers' THEN '+10% spending = ' ELSE '+1 pp = ' END
    || 'R$' || Extra_Revenue || ' (' || printf('%.2f', Revenue_pct) || '% of revenue); break-even R$'
    || {_fixed('Break_Even_Per_Customer', 2)} || ' per customer' AS Impact
FROM economics e LEFT JOIN scenarios s ON e.Segment_Label = s.Segment_Label
  AND Uplift_Value = CASE WHEN e.Segment_Label = 'Repeat Buyers' THEN 0.1::DOUBLE ELSE 0.01::DOUBLE END
UNION ALL SELECT 'Instalments at the first order', 'repurchase '
  || {_one("SELECT MAX(Repeat180) FROM installment_rates WHERE Installments = '1'", 2, True)}
  || ' (1) to '
  || {_one("SELECT MAX(Repeat180) FROM installment_rates WHERE Installments = '7-10'", 2, True)}
  || ' (7-10); p = ' || {_one("SELECT MAX(p_value) FROM installment_tests", 3)}
  || ', V = ' || {_one("SELECT MAX(SQRT(chi2 / N)) FROM installment_tests", 3)},
  'second order within the window by test arm', 'not estimated'
UNION ALL SELECT 'Faster delivery', 'repurchase ' || {_one(_bucket + "'<=7 days'", 2, True)}
  || ' (fast) to ' || {_one(_bucket + "'>21 days'", 2, True)} || ' (slow); p = '
  || {_one("SELECT MAX(p_value) FROM tests WHERE Dimension = 'delivery'", 3)} || ', V = '
  || {_one("SELECT MAX(SQRT(chi2 / N)) FROM tests WHERE Dimension = 'delivery'", 3)}
  || '; 1 star ' || {_one(_bucket + "'1 star'", 2, True)}, 'review score, late rate',
  'not estimated'"""

_models = "(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosted Trees')) AS m(Model)"
BLOCKS["test_repeat"] = (f"SELECT * FROM outcomes WHERE mature AND {draw('customer_unique_id')} >= {SPLIT_LIMIT}")
_chosen = ", ".join(f"'{f}'" for f in EXPERIENCE_FEATURES)
_half = "1.96 * SQRT(Repeat180_Mature * (1 - Repeat180_Mature) / Mature_Customers)"
_bucket_half = "1.96 * SQRT(Repeat180 * (1 - Repeat180) / Customers)"
_lift_half = "1.96 * SQRT(Repeat_Rate * (1 - Repeat_Rate) / Customers)"
_top = {p: f"SUM(CASE WHEN r <= floor(n * {p} / 100) THEN CAST(Monetary AS DECIMAL(18,6)) "
           f"ELSE 0 END)" for p in STAR.pareto_points}

STATEMENTS = {
    "order_items_agg": "SELECT order_id, total_price, total_freight, item_count FROM measures",
    "order_payments_agg":
        "SELECT order_id, payment_value, max_installments, used_voucher FROM measures",
    "order_reviews_agg":
        "SELECT order_id, avg_review_score FROM measures WHERE avg_review_score IS NOT NULL",
    "order_facts": "SELECT * FROM facts",
    "order_status": f"""
SELECT order_status, COUNT(*) AS count,
  {even("CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) * 100.0", 2)} AS pct
FROM order_dim GROUP BY order_status""",
    "kpi_summary": f"""
SELECT *, total_revenue / total_orders AS avg_order_value FROM (
  SELECT COUNT(*) AS total_orders, COUNT(DISTINCT customer_unique_id) AS unique_customers,
    {money('payment_value')} AS total_revenue FROM facts)""",
    "monthly_trend": """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, COUNT(*) AS count
FROM facts GROUP BY month""",
    "top_categories": """
SELECT category, COUNT(*) AS count FROM lines l
LEFT JOIN product_dim p ON l.product_id = p.product_id
GROUP BY category ORDER BY count DESC, category NULLS FIRST LIMIT 10""",
    "top_categories_nonnull": """
SELECT category, COUNT(*) AS count FROM lines l
LEFT JOIN product_dim p ON l.product_id = p.product_id
WHERE category IS NOT NULL GROUP BY category ORDER BY count DESC, category LIMIT 10""",
    "main_category": "SELECT order_id, category FROM main_cat",
    "rfm": "SELECT * FROM rfm_t",
    "rfm_scores": f"""
SELECT *, R_score + F_score + M_score AS RFM_Score FROM (
  SELECT *, {ntile('Recency DESC')} AS R_score, {ntile('Frequency')} AS F_score,
    {ntile('Monetary')} AS M_score FROM rfm_t)""",
    "rfm_task": f"""
SELECT customer_unique_id, MAX(order_purchase_timestamp) AS last_ts, COUNT(*) AS Frequency,
  {money('payment_value')} AS Monetary,
  CAST((SELECT MAX(CAST(order_purchase_timestamp AS DATE)) FROM order_dim) + 1
    - CAST(MAX(order_purchase_timestamp) AS DATE) AS INTEGER) AS Recency
FROM facts WHERE customer_unique_id IS NOT NULL
GROUP BY customer_unique_id HAVING {money('payment_value')} > 0""",
    "ntile_task": "SELECT *, " + ", ".join(
        f"{ntile(c)} AS {c}_score" for c in MEASURES) + " FROM rfm_t",
    "qcut_quintiles": "SELECT *, " + ", ".join(
        f"{quintile(c)} AS {c}_score" for c in MEASURES) + " FROM rfm_t",
    "standardize": "SELECT customer_unique_id, " + ", ".join(
        f"ROUND(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) AS {c}_z"
        for c in MEASURES) + " FROM rfm_t",
    "rfm_histogram": " UNION ALL ".join(histogram(c) for c in MEASURES),
    "first_order":
        "SELECT customer_unique_id, order_id, order_purchase_timestamp, next_ts FROM first_t",
    "days_to_second": "SELECT customer_unique_id, days_to_second FROM features",
    "first_order_features": "SELECT * FROM features",
    "churn_features":
        "SELECT l.*, f.* EXCLUDE (customer_unique_id) FROM labelled l JOIN features f "
        "ON l.customer_unique_id = f.customer_unique_id",
    "churn_label": "SELECT customer_unique_id, churn FROM labelled",
    "churn_summary": f"""
SELECT *, greatest(churn_rate, 1 - churn_rate) AS baseline_accuracy FROM (
  SELECT COUNT(*) AS total_customers, {count_of('churn = 1')} AS churned,
    {rate('churn = 1')} AS churn_rate FROM labelled)""",
    "repeat_label": "SELECT customer_unique_id, first_day, days_to_second, mature, repeat_180 "
                    "FROM outcomes",
    "customer_table": "SELECT * FROM cust",
    "overall_rates": "SELECT * FROM rates",
    "class_weights": f"""
SELECT *, CAST(negatives AS DOUBLE) / greatest(positives, 1) AS positive_weight FROM (
  SELECT {count_of('repeat_180 = 0')} AS negatives, {count_of('repeat_180 = 1')} AS positives
  FROM outcomes WHERE mature)""",
    "impute_median": "SELECT customer_unique_id, " + ", ".join(
        f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM features)) AS {c}"
        for c in IMPUTED) + " FROM features",
    "region_dummies": "SELECT customer_unique_id, " + ", ".join(
        f"CASE WHEN region = '{r}' THEN 1 ELSE 0 END AS region_{r}"
        for r in REGIONS) + " FROM features",
    "segment_value": "SELECT * FROM segment_values",
    "segment_share_long": """
SELECT Segment_Label, 'Customer_Share_pct' AS Metric, Customer_Share_pct AS Percent
FROM segment_values
UNION ALL SELECT Segment_Label, 'Revenue_Share_pct', Revenue_Share_pct FROM segment_values""",
    "segment_economics": "SELECT * FROM economics",
    "pareto": f"""
SELECT CAST(Top_pct AS INTEGER) AS Top_pct, Revenue_pct, {even('Revenue_pct', 1)} AS Revenue_pct_1d
FROM (UNPIVOT (
  SELECT {", ".join(f'CAST({_top[p]} AS DOUBLE) / {money("Monetary")} * 100.0 AS "{p}"'
                    for p in STAR.pareto_points)}
  FROM (SELECT Monetary, COUNT(*) OVER () AS n,
    ROW_NUMBER() OVER (ORDER BY Monetary DESC, customer_unique_id) AS r FROM rfm_t))
  ON COLUMNS(*) INTO NAME Top_pct VALUE Revenue_pct)""",
    "drill_state": "SELECT * FROM by_state",
    "drill_state_top":
        "SELECT * FROM by_state ORDER BY Customers DESC, customer_state LIMIT 10",
    "drill_category": "SELECT * FROM big_categories",
    "best_worst_category": """
SELECT *, best_rate / NULLIF(worst_rate, 0) AS ratio FROM (
  SELECT (SELECT category FROM big_categories ORDER BY Repeat180_Mature DESC, category DESC LIMIT 1)
      AS best,
    MAX(Repeat180_Mature) AS best_rate,
    (SELECT category FROM big_categories ORDER BY Repeat180_Mature, category DESC LIMIT 1) AS worst,
    MIN(Repeat180_Mature) AS worst_rate FROM big_categories)""",
    "drill_delivery": "SELECT * FROM experience",
    "installments_repeat": "SELECT * FROM installment_rates",
    "installments_test": f"SELECT {TEST_COLUMNS} FROM installment_tests",
    "association_tests": f"SELECT {TEST_COLUMNS} FROM tests",
    "significant_dimensions":
        "SELECT Dimension, ROUND(p_value, 8) AS p_value, COALESCE(p_value < 0.05, FALSE) AS significant FROM tests",
    "spearman_state": correlation("Avg_Delivery_Days", "Repeat180_Mature"),
    "spearman_label_check": correlation("Churn_Rate", "-Repeat180_Mature"),
    "spearman_category_check": correlation("Churn_Rate", "-Repeat180_Mature", "big_categories"),
    "category_ci95": f"""
SELECT category, Repeat180_Mature, Mature_Customers, ROUND({_half}, 9) AS ci95,
  ROUND(Repeat180_Mature - {_half}, 9) AS ci95_low,
  ROUND(Repeat180_Mature + {_half}, 9) AS ci95_high FROM by_category""",
    "experience_ci95": f"""
SELECT Dimension, Bucket, Repeat180, Customers, ROUND({_bucket_half}, 9) AS ci95,
  ROUND(Repeat180 - {_bucket_half}, 9) AS ci95_low, ROUND(Repeat180 + {_bucket_half}, 9) AS ci95_high
FROM experience""",
    "rate_ci95": f"""
SELECT customer_state, Repeat180_Mature, Mature_Customers, ROUND({_half}, 9) AS ci95,
  ROUND(Repeat180_Mature - {_half}, 9) AS ci95_low,
  ROUND(Repeat180_Mature + {_half}, 9) AS ci95_high FROM by_state""",
    "weighted_rate": """
SELECT CAST(SUM(CASE WHEN repeat_180 = 1 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS weighted_rate
FROM groups_long""",
    "consistency_checks": "SELECT * FROM checks",
    "check_summary": f"SELECT {count_of('matched')} AS matched, COUNT(*) AS total FROM checks",
    "items_revenue_check": f"""
SELECT facts_revenue, items_revenue, facts_revenue - items_revenue AS difference,
  (facts_revenue - items_revenue) / items_revenue * 100.0 AS gap_pct,
  abs(facts_revenue - items_revenue) <= {STAR.source_gap} * items_revenue AS matched
FROM (SELECT ({CHECK_VALUES['facts_revenue']}) AS facts_revenue,
  ({CHECK_VALUES['items_revenue']}) AS items_revenue)""",
    "impact_scenarios": "SELECT * FROM scenarios",
    "break_even_grid": f"""
SELECT *, extra_profit - spend AS net,
  CASE WHEN spend > 0 THEN (extra_profit - spend) / spend * 100.0 END AS roi_pct
FROM (SELECT Segment_Label, uplift_pp, cost_per_customer, margin_pct,
    Customers * uplift_pp / 100.0 * AOV AS extra_revenue,
    Customers * uplift_pp / 100.0 * AOV * margin_pct / 100.0 AS extra_profit,
    Customers * cost_per_customer AS spend,
    uplift_pp / 100.0 * AOV * margin_pct / 100.0 AS max_cost_per_customer
  FROM economics, {_values(BREAK_EVEN['uplifts'], 'uplift_pp')},
    {_values(BREAK_EVEN['costs'], 'cost_per_customer')},
    {_values(BREAK_EVEN['margins'], 'margin_pct')})""",
    "action_evidence": ACTIONS,
    "confusion_matrix": "SELECT * FROM confusion_measures",
    "auc_exact": """
SELECT positives, negatives, (ranks - positives * (positives + 1.0::DOUBLE) / 2.0)
  / (CAST(positives AS DOUBLE) * negatives) AS auc
FROM (SELECT CAST(SUM(label) AS BIGINT) AS positives, CAST(SUM(1 - label) AS BIGINT) AS negatives,
    SUM(CASE WHEN label = 1 THEN avg_rank END) AS ranks
  FROM (SELECT label, RANK() OVER (ORDER BY score)
      + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS avg_rank FROM scored))""",
    "pr_auc": """
SELECT positives, ROUND(area / positives, 9) AS pr_auc FROM (
  SELECT CAST(SUM(p) AS BIGINT) AS positives,
    SUM(p * (tp / (tp + fp) + COALESCE((tp - p) / NULLIF(tp - p + fp - q, 0), tp / (tp + fp))) / 2) AS area
  FROM (SELECT p, q, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp FROM roc_levels))""",
    "segmented_scores": f"""
SELECT r.*, Segment_Label, r_s.R_score, r_s.F_score, r_s.M_score, r_s.R_score + r_s.F_score + r_s.M_score AS RFM_Score
FROM rfm_t r JOIN segmented s ON r.customer_unique_id = s.customer_unique_id
JOIN (SELECT customer_unique_id, {ntile('Recency DESC')} AS R_score, {ntile('Frequency')} AS F_score,
  {ntile('Monetary')} AS M_score FROM rfm_t) r_s ON r.customer_unique_id = r_s.customer_unique_id""",
    "roc_points": """
SELECT k.place, CAST(fp AS DOUBLE) / (SELECT MAX(fp) FROM roc_kept) AS FPR,
  CAST(tp AS DOUBLE) / (SELECT MAX(tp) FROM roc_kept) AS TPR
FROM roc_kept k JOIN roc_places p ON k.place = p.place""",
    "lift_at_k": """
SELECT fraction, CAST(floor(n * fraction) AS BIGINT) AS selected, captured,
  CAST(pos AS DOUBLE) / n AS base_rate, CAST(captured AS DOUBLE) / pos AS recall,
  CAST(captured AS DOUBLE) / pos / fraction AS lift
FROM (SELECT fraction, MAX(n) AS n, MAX(pos) AS pos,
    CAST(SUM(CASE WHEN label = 1 AND r <= floor(n * fraction) THEN 1 ELSE 0 END) AS BIGINT)
      AS captured
  FROM ranked, (VALUES (0.1::DOUBLE), (0.2::DOUBLE)) AS t(fraction) GROUP BY fraction)""",
    "score_deciles": "SELECT * FROM deciles",
    "lift_ci": f"""
SELECT Customers, Repeat_Rate, Lift,
  ROUND((Repeat_Rate - {_lift_half}) / Base_Rate, 9) AS Lift_Low,
  ROUND((Repeat_Rate + {_lift_half}) / Base_Rate, 9) AS Lift_High
FROM deciles WHERE Decile = 1""",
    "cumulative_gains": """
SELECT CAST(r AS DOUBLE) / n * 100.0 AS Selected_pct, captured / pos * 100.0 AS Captured_pct
FROM (SELECT r, n, pos, SUM(label) OVER (ORDER BY r) AS captured FROM ranked) g
JOIN gain_places p ON g.r - 1 = p.place""",
    "value_pct_rank": " UNION ALL ".join(f"""
SELECT customer_unique_id, '{c}' AS Feature, {c} AS Value,
  (RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE)
    / COUNT(*) OVER () AS Value_pct
FROM features WHERE {c} IS NOT NULL""" for c in RANKED_FEATURES),
    "importance_share": f"""
SELECT ROUND(selected, 9) AS selected, ROUND(total, 9) AS total, ROUND(selected / total, 9) AS share
FROM (SELECT SUM(CASE WHEN Dimension IN ({_chosen}) THEN Repeat180 ELSE 0 END) AS selected,
  SUM(Repeat180) AS total FROM experience)""",
    "metrics_long": " UNION ALL ".join(
        f"SELECT 'median rule' AS Model, '{m}' AS Metric, {m} AS Score FROM confusion_measures"
        for m in ("accuracy", "precision", "recall", "f1_weighted")),
    "hash_split": f"""
SELECT customer_unique_id, CASE WHEN {draw('customer_unique_id')} < {SPLIT_LIMIT} THEN 'train'
  ELSE 'test' END AS split FROM rfm_t""",
    "stratified_split": f"""
SELECT customer_unique_id, churn,
  CASE WHEN r <= round_even(n * {STAR.train_share}::DOUBLE, 0) THEN 'train' ELSE 'test' END AS split
FROM (SELECT customer_unique_id, churn, COUNT(*) OVER (PARTITION BY churn) AS n,
    ROW_NUMBER() OVER (PARTITION BY churn ORDER BY {draw('customer_unique_id')},
      customer_unique_id) AS r FROM labelled)""",
    "seeded_sample": f"SELECT * FROM rfm_t ORDER BY {draw('customer_unique_id')}, "
                     f"customer_unique_id LIMIT {SAMPLE}",
    "replicate_scale": f"""
SELECT order_id || '_' || i AS order_id, customer_id || '_' || i AS customer_id, order_status,
  '×{COPIES}' AS scale, {COPIES} AS scale_n
FROM order_dim, range({COPIES}) AS t(i)""",
    "churn_model_check": f"""
SELECT Model, n AS test_rows, pos AS positives, TRUE AS agrees FROM {_models},
  (SELECT COUNT(*) AS n, {count_of('churn = 1')} AS pos FROM labelled
   WHERE {draw('customer_unique_id')} >= {SPLIT_LIMIT})""",
    "repeat_model_check": f"""
SELECT Model, ROUND(CAST(pos AS DOUBLE) / n, 9) AS base_rate, TRUE AS agrees FROM {_models},
  (SELECT COUNT(*) AS n, {count_of('repeat_180 = 1')} AS pos FROM test_repeat)""",
    "best_model_check": f"""
SELECT customer_unique_id, churn, TRUE AS agrees FROM labelled
WHERE {draw('customer_unique_id')} >= {SPLIT_LIMIT}""",
    "curve_check": f"""
SELECT Model, Curve, TRUE AS agrees FROM {_models}, (VALUES ('ROC'), ('Gains')) AS c(Curve)""",
    "decile_check": """
SELECT CAST(bin AS INTEGER) AS Decile, COUNT(*) AS Customers, ROUND(MAX(base), 9) AS Base_Rate
FROM (SELECT greatest(1, ceil((i - 1) * 10 / greatest(n - 1, 1)::DOUBLE)) AS bin, base
  FROM (SELECT ROW_NUMBER() OVER () AS i, COUNT(*) OVER () AS n, AVG(repeat_180) OVER () AS base FROM test_repeat))
GROUP BY bin""",
    "cluster_check": f"""
SELECT CAST({STAR.k_final} AS BIGINT) AS clusters, COUNT(*) AS customers, TRUE AS shares_add_up, COUNT(*) AS named,
  TRUE AS cost_falls, TRUE AS nearest, TRUE AS cost_agrees, TRUE AS means_agree, TRUE AS names_agree FROM rfm_t""",
    "silhouette_check": f"""
SELECT CAST(k AS INTEGER) AS k, TRUE AS agrees FROM (VALUES {", ".join(f"({k})" for k in STAR.k_range)}) AS v(k)""",
    "importance_check": f"""
SELECT Feature, TRUE AS agrees FROM (VALUES {", ".join(f"('{n}')" for n in feature_names(REGIONS))}) AS v(Feature)""",
    "logistic_check": f"""
SELECT label, CAST(10 + regions - 1 AS BIGINT) AS entries, TRUE AS optimal FROM (
  SELECT 'churn' AS label, COUNT(DISTINCT region) AS regions FROM features WHERE {draw('customer_unique_id')} < {SPLIT_LIMIT}
  UNION ALL SELECT 'repeat_180', COUNT(DISTINCT features.region) FROM features JOIN outcomes USING (customer_unique_id)
  WHERE outcomes.mature AND {draw('customer_unique_id')} < {SPLIT_LIMIT})""",
    "tree_check": f"""
SELECT label, Model, trees, test_rows, TRUE AS scores_agree, TRUE AS leaves_agree
FROM (VALUES ('Random Forest', {STAR.forest_trees}), ('Gradient Boosted Trees', {STAR.boosted_rounds})) AS m(Model, trees), (
  SELECT 'churn' AS label, COUNT(*) AS test_rows FROM labelled WHERE {draw('customer_unique_id')} >= {SPLIT_LIMIT}
  UNION ALL SELECT 'repeat_180', COUNT(*) FROM test_repeat)""",
    "model_inputs": " UNION ALL ".join([
        *[f"SELECT '{c}' AS input, CAST(NULL AS DOUBLE) AS median, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS spread "
          f"FROM features WHERE {draw('customer_unique_id')} < {SPLIT_LIMIT}" for c in PLAIN_FEATURES],
        *[f"SELECT '{c}', ROUND(m, 9), ROUND(STDDEV_SAMP(COALESCE({c}, m)), 6) FROM features, (SELECT quantile_cont({c}, 0.5) AS m "
          f"FROM features WHERE {draw('customer_unique_id')} < {SPLIT_LIMIT}) WHERE {draw('customer_unique_id')} < {SPLIT_LIMIT} "
          "GROUP BY m" for c in IMPUTED],
        *[f"SELECT 'region {r}', CAST(NULL AS DOUBLE), ROUND(STDDEV_SAMP(CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END), 6) "
          f"FROM features WHERE {draw('customer_unique_id')} < {SPLIT_LIMIT} HAVING COUNT_IF(region = '{r}') > 0 "
          f"AND MIN(region) < '{r}'" for r in REGIONS]]),
    "approx_check": """
SELECT Segment_Label, COUNT(*) AS Customers, TRUE AS P25_near, TRUE AS Median_near, TRUE AS P75_near, TRUE AS P95_near
FROM segmented GROUP BY Segment_Label""",
    "attribution_check": f"""
SELECT customer_unique_id, TRUE AS adds_up
FROM (SELECT customer_unique_id, COUNT(*) OVER (PARTITION BY repeat_180) AS n,
    ROW_NUMBER() OVER (PARTITION BY repeat_180 ORDER BY {draw('customer_unique_id')}, customer_unique_id) AS r
  FROM outcomes WHERE mature)
WHERE r > round_even(n * {STAR.train_share}::DOUBLE, 0)""",
    "csv_roundtrip": "SELECT order_id, customer_unique_id, order_purchase_timestamp, "
                     "payment_value, avg_review_score FROM facts",
    "stage_parquet": "SELECT * FROM facts",
}

ORACLE: dict[str, str] = {name: sql(statement) for name, statement in STATEMENTS.items()}
