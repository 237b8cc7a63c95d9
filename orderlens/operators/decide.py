"""Reconciliation checks, impact scenarios, break-even grid and action table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.labels import AT_RISK, LOST, RECENT, REPEAT
from orderlens.functions.numbers import exact_sum, percent, round_even
from orderlens.settings import Settings

ONE_TIME = (RECENT, AT_RISK, LOST)

EXACT, MONEY, SOURCE = "exact", "money", "source"

# Fixed values: (metric, source A, its value, source B, its value); values name a measure below.
_COMPARED = (
    ("customers", "segmented", "seg_customers", "customer table", "cust_customers"),
    ("customers", "segmented", "seg_customers", "sum over segments", "by_segment_customers"),
    ("customers", "segmented", "seg_customers", "sum over states", "by_state_customers"),
    ("customers", "segmented", "seg_customers", "sum over categories", "by_category_customers"),
    ("mature customers", "customer table", "cust_mature", "sum over states", "by_state_mature"),
    ("mature customers", "customer table", "cust_mature", "sum over categories",
     "by_category_mature"),
    ("orders", "order facts", "facts_orders", "sum of Frequency", "seg_orders"),
    ("revenue", "order facts", "facts_revenue", "sum of Monetary", "seg_revenue"),
    ("revenue", "order facts", "facts_revenue", "sum over segments", "by_segment_revenue"),
    ("revenue", "order facts", "facts_revenue", "sum over states", "by_state_revenue"),
    ("revenue", "order facts", "facts_revenue", "sum over categories", "by_category_revenue"),
    ("churned customers", "customer table", "cust_churned", "sum over segments",
     "by_segment_churned"),
    ("churned customers", "customer table", "cust_churned", "sum over states", "by_state_churned"),
    ("churned customers", "customer table", "cust_churned", "sum over categories",
     "by_category_churned"),
    ("revenue", "order facts", "facts_revenue", "items (price + freight)", "items_revenue"),
)
# The kind of tolerance of each check: none, a sum of money, or a share between two sources.
CHECKS = tuple((*row, SOURCE if row[4] == "items_revenue" else MONEY if row[2].endswith("_revenue") else EXACT)
               for row in _COMPARED)


def items_revenue(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Price plus freight of the items of kept orders, as one row."""
    kept = items.join(facts.select("order_id"), "order_id", "left_semi")
    return kept.agg(exact_sum("price + freight_value").alias("items_revenue"))


def items_revenue_check(items: DataFrame, facts: DataFrame, settings: Settings) -> DataFrame:
    """Gap between paid revenue and item revenue of the same orders."""
    paid = facts.agg(exact_sum("payment_value")).scalar()
    both = items_revenue(items, facts).withColumn("facts_revenue", paid)
    diff = F.col("facts_revenue") - F.col("items_revenue")
    return both.select(
        "facts_revenue", "items_revenue", diff.alias("difference"),
        percent(diff, F.col("items_revenue")).alias("gap_pct"),
        (F.abs(diff) <= settings.source_gap * F.col("items_revenue")).alias("matched"))


def _measures(df: DataFrame, **values: Column) -> DataFrame:
    """One-row totals as (name, value) rows."""
    named = F.array(*[F.struct(F.lit(k).alias("name"), v.cast("double").alias("value"))
                      for k, v in values.items()])
    return df.agg(named.alias("_m")).select(F.explode("_m").alias("m")).select("m.*")


def _customer_measures(cust: DataFrame) -> DataFrame:
    """Totals of the customer table and of its groups by three columns, from one pass (grouping sets)."""
    columns = {"Segment_Label": "segment", "customer_state": "state", "category": "category"}
    names = list(columns)
    groups = cust.groupingSets([[], *[[c] for c in names]], *names).agg(
        F.grouping_id(*names).alias("_set"), F.count(F.lit(1)).alias("customers"),
        F.count_if("mature").alias("mature"), exact_sum("Monetary").alias("revenue"),
        exact_sum("churn").alias("churned"))
    # Bit i of the id is set where column i, counted from the last, is summed over.
    named = {0b111: "cust", 0b011: "by_segment", 0b101: "by_state", 0b110: "by_category"}
    source = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])[F.col("_set").cast("int")]
    sums = groups.groupBy(source.alias("of")).agg(
        F.sum("customers").alias("customers"), F.sum("mature").alias("mature"),
        exact_sum("revenue").alias("revenue"), exact_sum("churned").alias("churned"))
    pairs = F.array(*[F.struct(F.concat("of", F.lit(f"_{m}")).alias("name"), F.col(m).cast("double").alias("value"))
                      for m in ("customers", "mature", "revenue", "churned")])
    return sums.select(F.explode(pairs).alias("m")).select("m.*")


def consistency_checks(
    facts: DataFrame, items: DataFrame, segmented: DataFrame, cust: DataFrame, settings: Settings
) -> DataFrame:
    """Fifteen comparisons between totals and the sums of their parts."""
    count = F.count(F.lit(1))
    parts = [
        _measures(facts, facts_orders=count, facts_revenue=exact_sum("payment_value")),
        _measures(segmented, seg_customers=count, seg_orders=F.sum("Frequency"),
                  seg_revenue=exact_sum("Monetary")),
        _measures(items_revenue(items, facts), items_revenue=F.max("items_revenue")),
        _customer_measures(cust),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    values = every.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("v"))
    listed = F.array(*[F.struct(
        F.lit(i).alias("check_id"), F.lit(metric).alias("metric"), F.lit(a).alias("source_a"),
        F.col("v")[va].alias("value_a"), F.lit(b).alias("source_b"),
        F.col("v")[vb].alias("value_b"), F.lit(kind).alias("_kind"))
        for i, (metric, a, va, b, vb, kind) in enumerate(CHECKS, start=1)])
    rows = values.select(F.explode(listed).alias("c")).select("c.*")
    allowed = (F.when(F.col("_kind") == SOURCE, settings.source_gap * F.col("value_b"))
               .when(F.col("_kind") == MONEY, settings.money_tolerance).otherwise(0.0))
    diff = F.col("value_a") - F.col("value_b")
    gap = round_even(percent(diff, F.col("value_b")), 2)
    return rows.withColumns({
        "difference": round_even(diff, 2),
        "matched": F.abs(diff) <= allowed,
        "gap_pct": F.when(F.col("_kind") == SOURCE, gap)}).drop("_kind")


def check_summary(checks: DataFrame) -> DataFrame:
    """Matched and total number of checks."""
    return checks.agg(F.count_if("matched").alias("matched"), F.count(F.lit(1)).alias("total"))


def segment_economics(segmented: DataFrame) -> DataFrame:
    """Customers, revenue, orders and average order value per segment."""
    return segmented.groupBy("Segment_Label").agg(
        F.count(F.lit(1)).alias("Customers"),
        exact_sum("Monetary").alias("Revenue"),
        F.sum("Frequency").alias("Orders"),
    ).withColumn("AOV", F.try_divide("Revenue", "Orders"))


def _total_revenue(economics: DataFrame) -> Column:
    return economics.agg(exact_sum("Revenue")).scalar()


def impact_scenarios(economics: DataFrame, settings: Settings) -> DataFrame:
    """What an uplift would be worth per segment, and the most it may cost per customer.

    One-time segments: u more customers in a hundred place a second order.
    Repeat segment: spending rises by a share u. A segment that is not in the
    data simply has no rows.
    """
    one_time = F.array(*[F.lit(u) for u in settings.uplift_points])
    repeat = F.array(*[F.lit(u) for u in settings.uplift_spend])
    is_repeat = F.col("Segment_Label") == REPEAT
    grid = (economics.withColumn("_total", _total_revenue(economics))
            .filter(F.col("Segment_Label").isin(*ONE_TIME, REPEAT))
            .withColumn("u", F.explode(F.when(is_repeat, repeat).otherwise(one_time))))
    u = F.col("u")
    orders = F.when(is_repeat, F.col("Orders") * u).otherwise(F.col("Customers") * u)
    revenue = F.when(is_repeat, F.col("Revenue") * u).otherwise(
        F.col("Customers") * u * F.col("AOV"))
    breakeven = F.when(is_repeat, F.try_divide(F.col("Revenue") * u, F.col("Customers"))
                       ).otherwise(u * F.col("AOV"))
    text = F.when(is_repeat, F.format_string("+%d%% spending", F.rint(u * 100).cast("int"))
                  ).otherwise(F.format_string("+%.1f pp second order", u * 100))
    return grid.select(
        "Segment_Label", text.alias("Uplift"), u.alias("Uplift_Value"),
        F.col("Customers").alias("Target_Customers"),
        F.rint(orders).cast("long").alias("Extra_Orders"),
        F.rint(revenue).cast("long").alias("Extra_Revenue"),
        round_even(percent(revenue, F.col("_total")), 2).alias("Revenue_pct"),
        round_even(breakeven, 2).alias("Break_Even_Per_Customer"))


def break_even_grid(
    economics: DataFrame, uplifts: tuple[float, ...], costs: tuple[float, ...],
    margins: tuple[float, ...],
) -> DataFrame:
    """Profit of a campaign for every combination of uplift (pp), cost and margin (%)."""

    def each(values: tuple[float, ...]) -> Column:
        return F.explode(F.array(*[F.lit(float(v)) for v in values]))

    grid = (economics.withColumn("uplift_pp", each(uplifts))
            .withColumn("cost_per_customer", each(costs))
            .withColumn("margin_pct", each(margins)))
    rev = F.col("Customers") * F.col("uplift_pp") / 100.0 * F.col("AOV")
    return grid.select(
        "Segment_Label", "uplift_pp", "cost_per_customer", "margin_pct",
        rev.alias("extra_revenue"),
        (rev * F.col("margin_pct") / 100.0).alias("extra_profit"),
        (F.col("Customers") * F.col("cost_per_customer")).alias("spend"),
        (F.col("uplift_pp") / 100.0 * F.col("AOV") * F.col("margin_pct") / 100.0)
        .alias("max_cost_per_customer"),
    ).withColumn("net", F.col("extra_profit") - F.col("spend")).withColumn(
        "roi_pct", F.try_divide(F.col("net"), F.when(F.col("spend") > 0, F.col("spend"))) * 100.0)


def _pct(value: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", round_even(value * 100.0, digits))


def action_evidence(
    economics: DataFrame, scenarios: DataFrame, category_rates: DataFrame, rates: DataFrame,
    installments: DataFrame, installment_tests: DataFrame, experience: DataFrame,
    tests: DataFrame, uplift_point: float = 0.01, uplift_spend: float = 0.10, currency: str = "R$",
) -> DataFrame:
    """Evidence and what-if impact behind each action: four segments and two themes.

    All inputs are short reports; the text is formatted from their values. The impact is that of
    the scenario with ``uplift_point`` (one-time segments) or ``uplift_spend`` (repeat buyers);
    where the scenarios have none, it is "not estimated".
    """
    def _money(value: Column, digits: int = 0) -> Column:
        return F.concat(F.lit(currency), F.format_string(f"%.{digits}f", round_even(value, digits)))

    chosen = F.when(F.col("Segment_Label") == REPEAT, float(uplift_spend)).otherwise(float(uplift_point))
    total = F.struct(exact_sum("Revenue").alias("revenue"), F.sum("Customers").alias("customers"))
    one_step = scenarios.filter(F.col("Uplift_Value") == chosen).select(
        "Segment_Label", "Extra_Revenue", "Revenue_pct", "Break_Even_Per_Customer")
    best_two = (category_rates.orderBy(F.desc("Repeat180_Mature"), "category").limit(2)
                .agg(F.nullif(F.array_join(F.sort_array(F.collect_list("category")), ", "), F.lit("")))
                .scalar())
    base = rates.select("repeat_rate").scalar()
    seg = (economics.withColumns({
        "_t": economics.agg(total).scalar(), "_best": best_two, "_base": base})
        .join(one_step, "Segment_Label", "left"))
    people, money = F.col("Customers") / F.col("_t.customers"), F.col("Revenue") / F.col("_t.revenue")
    shares = F.concat(_pct(people), F.lit(" of customers, "), _pct(money), F.lit(" of revenue"))
    label = F.col("Segment_Label")
    evidence = (
        F.when(label == RECENT, F.concat(
            shares, F.lit("; best repeat categories: "), F.coalesce("_best", F.lit("none"))))
        .when(label == REPEAT, F.concat(
            shares, F.lit("; spends "), _money(F.col("Revenue") / F.col("Customers")),
            F.lit(" per customer")))
        .otherwise(F.concat(shares, F.lit("; order value "), _money(F.col("AOV")))))
    kpi = F.when(label == REPEAT, F.lit("orders per customer")).otherwise(
        F.concat(F.lit("second order within the window, base "), _pct(F.col("_base"))))
    impact = F.concat(
        F.when(label == REPEAT, F.lit(f"+{uplift_spend * 100:g}% spending = "))
        .otherwise(F.lit(f"+{uplift_point * 100:g} pp = ")),
        _money(F.col("Extra_Revenue").cast("double")), F.lit(" ("),
        F.format_string("%.2f%%", F.col("Revenue_pct")), F.lit(" of revenue); break-even "),
        _money(F.col("Break_Even_Per_Customer"), 2), F.lit(" per customer"))
    impact = F.coalesce(impact, F.lit("not estimated"))
    segments = seg.select(label.alias("Topic"), evidence.alias("Evidence"), kpi.alias("KPI"),
                          impact.alias("Impact"))

    def pick(report: DataFrame, where: Column, value: str) -> Column:
        return report.filter(where).agg(F.max(value)).scalar()

    one = economics.sparkSession.range(1)
    paid = one.select(
        pick(installments, F.col("Installments") == "1", "Repeat180").alias("lo"),
        pick(installments, F.col("Installments") == "7-10", "Repeat180").alias("hi"),
        installment_tests.agg(F.max("p_value")).scalar().alias("p"),
        installment_tests.agg(F.max("Cramers_V")).scalar().alias("v"))
    sent = one.select(
        pick(experience, F.col("Bucket") == "<=7 days", "Repeat180").alias("lo"),
        pick(experience, F.col("Bucket") == ">21 days", "Repeat180").alias("hi"),
        pick(experience, F.col("Bucket") == "1 star", "Repeat180").alias("star"),
        pick(tests, F.col("Dimension") == "delivery", "p_value").alias("p"),
        pick(tests, F.col("Dimension") == "delivery", "Cramers_V").alias("v"))

    def or_na(text: Column) -> Column:
        return F.coalesce(text, F.lit("n/a"))

    def number(name: str) -> Column:
        return or_na(F.when(F.col(name).isNotNull(),
                            F.format_string("%.3f", round_even(F.col(name), 3))))

    def rate(name: str) -> Column:
        return or_na(F.when(F.col(name).isNotNull(), _pct(F.col(name), 2)))

    def theme(df: DataFrame, topic: str, evidence_text: Column, kpi_text: str) -> DataFrame:
        return df.select(F.lit(topic).alias("Topic"), evidence_text.alias("Evidence"),
                         F.lit(kpi_text).alias("KPI"), F.lit("not estimated").alias("Impact"))

    tail = [F.lit("; p = "), number("p"), F.lit(", V = "), number("v")]
    paid_text = F.concat(F.lit("repurchase "), rate("lo"), F.lit(" (1) to "), rate("hi"),
                         F.lit(" (7-10)"), *tail)
    sent_text = F.concat(F.lit("repurchase "), rate("lo"), F.lit(" (fast) to "), rate("hi"),
                         F.lit(" (slow)"), *tail, F.lit("; 1 star "), rate("star"))
    return (segments
            .unionByName(theme(paid, "Instalments at the first order", paid_text,
                               "second order within the window by test arm"))
            .unionByName(theme(sent, "Faster delivery", sent_text, "review score, late rate")))
