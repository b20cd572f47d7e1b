"""Subscriptions: orders are subscriptions, order lines are payments, customers are customers."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.calendar import month_spine
from millrace.plans import increments
from millrace.plans import subscriptions as subs
from millrace.session import scratch_path, write_once
from millrace.sources.warehouse import Warehouse, look_up
from workload import table

AS_OF = date(2001, 8, 1)
# The plans.
PLANS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _cents(col: str):
    return F.floor(F.col(col) * 100 + 0.5)


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Padded names, upper-case addresses, and sign-up dates of which some are blank, partial or no dates at all."""
    key = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit(date(1995, 1, 1)), (key % 1000).cast("int")), "yyyy-MM-dd")
    spoilt = (
        F.when(key % 10 == 0, " ")
        .when(key % 10 == 1, "not a date")
        .when(key % 10 == 2, "1995-02")
        .when(key % 10 == 3, "1995-02-30")
        .otherwise(F.concat(F.lit(" "), day))
    )
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("customer_name"),
            F.concat(F.lit(" "), F.upper("c_name"), F.lit("@MAIL.EXAMPLE")).alias("email"),
            spoilt.alias("signup_date"),
            F.col("n_name").alias("country"),
        )
    )


def raw_subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Open while the order status is O; a few end before they start."""
    key = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    length = F.when(key % 97 == 0, -40).otherwise((key % 400).cast("int"))
    end = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.date_format(F.date_add(start, length), "yyyy-MM-dd"))
    return table(spark, sf, "orders").select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("plan_type"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        end.alias("end_date"),
        _cents("o_totalprice").alias("monthly_price_cents"),
        F.when(F.col("o_orderstatus") == "O", "active")
        .when(F.col("o_orderstatus") == "F", "canceled")
        .otherwise("trial")
        .alias("status"),
    )


def raw_payments(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("payment_date"),
        _cents("l_extendedprice").alias("amount_cents"),
        F.when(flag == "N", "success").when(flag == "A", "failed").otherwise("refunded").alias("status"),
    )


def customers(s, d):
    return subs.stg_customers(raw_customers(s, d))


def subscriptions(s, d):
    return subs.stg_subscriptions(raw_subscriptions(s, d))


def payments(s, d):
    return subs.stg_payments(raw_payments(s, d))


def mrr(s, d):
    return subs.fct_mrr(subscriptions(s, d), AS_OF)


def dim_customers(s, d):
    return subs.dim_customers(customers(s, d), subscriptions(s, d))


def fct_subscriptions(s, d):
    return subs.fct_subscriptions(subscriptions(s, d), payments(s, d), AS_OF)


def model_tests(s, d):
    raw = {
        "raw_customers": raw_customers(s, d),
        "raw_subscriptions": raw_subscriptions(s, d),
        "raw_payments": raw_payments(s, d),
    }
    return subs.check_models(subs.build_models(raw, AS_OF))


def mrr_increment(s, d):
    """The revenue mart after three batches of changes, with two months of reports between them.

    A third of the subscriptions is first open and ended by the second batch, another third begins with another plan and
    price that the third batch corrects, and the rest arrives with the later batches.
    """
    final = subscriptions(s, d).select("subscription_id", "plan_type", "start_date", "end_date", "monthly_price_usd")
    final = write_once(final, "subscriptions")
    third = [final.filter(F.col("subscription_id") % 3 == i) for i in range(3)]
    opened = third[0].withColumn("end_date", F.lit(None).cast("date"))
    wrong = third[1].withColumns({"plan_type": F.lit(PLANS[-1]), "monthly_price_usd": F.col("monthly_price_usd") + 1})
    new = [third[2].filter(F.col("subscription_id") % 2 == i) for i in range(2)]
    none = final.limit(0)
    batches = [
        (none, opened.unionByName(wrong), date(1997, 3, 31)),
        (opened, third[0].unionByName(new[0]), date(1997, 4, 1)),
        (wrong, third[1].unionByName(new[1]), AS_OF),
    ]
    warehouse = Warehouse(s, scratch_path(s, "warehouse"))
    for number, (before, after, as_of) in enumerate(batches):
        increments.increment_mrr(warehouse, increments.signed_rows(before, after), as_of, ("mrr", number))
    return increments.read_mrr(warehouse)


def scd2_increment(s, d):
    """The plan history after three batches: older days, newer ones, and a seventh of all days that come late."""
    rows = write_once(subscriptions(s, d).select("subscription_id", "customer_id", "plan_type", "start_date"), "subscriptions")
    late, old = F.col("subscription_id") % 7 == 0, F.col("start_date") < date(1996, 6, 1)
    warehouse = Warehouse(s, scratch_path(s, "warehouse"))
    for number, mine in enumerate((~late & old, ~late & ~old, late)):
        increments.increment_history(warehouse, rows.filter(mine), ("history", number))
    return increments.read_history(warehouse)


def _stored_models(s, d):
    raw = {"raw_customers": raw_customers(s, d), "raw_subscriptions": raw_subscriptions(s, d), "raw_payments": raw_payments(s, d)}
    return subs.save_models(raw, AS_OF, scratch_path(s, "layers"))


def layers(s, d):
    """Revenue per plan of the stored marts, joined with the staging view they come from."""
    models = _stored_models(s, d)
    facts = models["fct_subscriptions"].select("subscription_id", "total_paid_usd", "duration_months")
    return models["stg_subscriptions"].join(facts, "subscription_id").select("subscription_id", "status", "total_paid_usd", "duration_months")


def catalog(s, d):
    """Which tables a report finds, and how many rows each of them has."""
    _stored_models(s, d)
    names = ["raw.raw_payments", "stg_payments", "marts.fct_subscriptions", "marts.dim_customers", "marts.no_such_table"]
    found = look_up(s, names)
    rows = [s.table(n).select(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows")) for n in names if s.catalog.tableExists(n)]
    return found.join(reduce(DataFrame.unionByName, rows), "name", "left")


QUERIES = {
    "sub_stg_customers": customers,
    "sub_stg_subscriptions": subscriptions,
    "sub_stg_payments": payments,
    "sub_latest_subscription": lambda s, d: subs.latest_subscription(subscriptions(s, d)),
    "sub_dim_customers": dim_customers,
    "sub_payment_agg": lambda s, d: subs.payment_totals(payments(s, d)),
    "sub_fct_subscriptions": lambda s, d: fct_subscriptions(s, d),
    "sub_month_spine": lambda s, d: month_spine(subscriptions(s, d), "start_date", AS_OF),
    "sub_fct_mrr": mrr,
    "sub_mrr_delta": lambda s, d: subs.mrr_delta(mrr(s, d)),
    "sub_mrr_pivot": lambda s, d: subs.mrr_pivot(mrr(s, d), PLANS),
    "sub_top_plan": lambda s, d: subs.top_plan(mrr(s, d)),
    "sub_customer_kpis": lambda s, d: subs.customer_kpis(dim_customers(s, d)),
    "sub_plan_mix": lambda s, d: subs.plan_mix(dim_customers(s, d)),
    "sub_revenue_by_plan": lambda s, d: subs.revenue_by_plan(fct_subscriptions(s, d)),
    "sub_paid_summary": lambda s, d: subs.paid_summary(fct_subscriptions(s, d)),
    "sub_churn_rate": lambda s, d: subs.churn_rate(subscriptions(s, d), AS_OF),
    "sub_customer_ltv": lambda s, d: subs.customer_ltv(subscriptions(s, d), payments(s, d)),
    "sub_scd2": lambda s, d: subs.plan_history(subscriptions(s, d)),
    "sub_mrr_increment": mrr_increment,
    "sub_scd2_increment": scd2_increment,
    "sub_layers": layers,
    "sub_catalog": catalog,
    "sub_model_tests": model_tests,
}

_AS_OF = f"DATE '{AS_OF}'"
_MODELS = f"""
WITH stg_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@mail.example' AS email,
    CASE WHEN c_custkey % 10 IN (0, 1, 2, 3) THEN NULL
      ELSE DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS signup_date,
    n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), stg_subscriptions AS (
  SELECT o_orderkey AS subscription_id, o_custkey AS customer_id, o_orderpriority AS plan_type,
    CAST(o_orderdate AS DATE) AS start_date,
    CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 97 = 0 THEN CAST(o_orderdate AS DATE) - 40
      ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS end_date,
    round(o_totalprice, 2) AS monthly_price_usd,
    CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'canceled' ELSE 'trial' END AS status
  FROM orders
), stg_payments AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS payment_id, l_orderkey AS subscription_id,
    CAST(l_shipdate AS DATE) AS payment_date, round(l_extendedprice, 2) AS amount_usd,
    CASE l_returnflag WHEN 'N' THEN 'success' WHEN 'A' THEN 'failed' ELSE 'refunded' END AS payment_status
  FROM lineitem
), latest AS (
  SELECT * FROM stg_subscriptions
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY start_date DESC, subscription_id DESC) = 1
), dim_customers AS (
  SELECT c.*, plan_type AS current_plan_type, status AS current_subscription_status,
    monthly_price_usd AS current_monthly_price_usd, status = 'active' AS is_active_subscriber
  FROM stg_customers c LEFT JOIN latest l USING (customer_id)
), payment_agg AS (
  SELECT subscription_id,
    CAST(sum(CASE WHEN payment_status = 'success' THEN CAST(amount_usd AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE)
      AS total_paid_usd,
    count(CASE WHEN payment_status = 'success' THEN 1 END) AS successful_payments,
    count(CASE WHEN payment_status = 'failed' THEN 1 END) AS failed_payments
  FROM stg_payments GROUP BY 1
), fct_subscriptions AS (
  SELECT s.subscription_id, s.customer_id, s.plan_type, s.status, s.start_date, s.end_date, s.monthly_price_usd,
    date_diff('month', s.start_date, coalesce(s.end_date, {_AS_OF})) AS duration_months,
    coalesce(total_paid_usd, 0) AS total_paid_usd, coalesce(successful_payments, 0) AS successful_payments,
    coalesce(failed_payments, 0) AS failed_payments
  FROM stg_subscriptions s LEFT JOIN payment_agg USING (subscription_id)
), months AS (
  SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(start_date)) FROM stg_subscriptions),
    date_trunc('month', {_AS_OF}), INTERVAL 1 MONTH)) AS DATE) AS month_start
), fct_mrr AS (
  SELECT month_start, plan_type, count(DISTINCT subscription_id) AS active_subscriptions,
    CAST(sum(CAST(monthly_price_usd AS DECIMAL(18, 2))) AS DOUBLE) AS mrr_usd
  FROM months JOIN stg_subscriptions ON date_trunc('month', start_date) <= month_start
    AND (end_date IS NULL OR date_trunc('month', end_date) >= month_start)
  GROUP BY 1, 2
)
"""
_UNIQUE = {
    "stg_customers": "customer_id",
    "stg_subscriptions": "subscription_id",
    "stg_payments": "payment_id",
    "dim_customers": "customer_id",
    "fct_subscriptions": "subscription_id",
}
_NOT_NULL = [
    *_UNIQUE.items(),
    ("stg_customers", "email"),
    ("stg_subscriptions", "customer_id"),
    ("stg_payments", "subscription_id"),
    ("fct_subscriptions", "total_paid_usd"),
    ("fct_mrr", "mrr_usd"),
]
_TESTS = [
    *[
        (f"unique {m}.{c}", f"(SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for m, c in _UNIQUE.items()
    ],
    *[(f"not_null {m}.{c}", f"{m} WHERE {c} IS NULL") for m, c in _NOT_NULL],
    (
        "relationships stg_subscriptions.customer_id",
        "stg_subscriptions WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)",
    ),
    (
        "relationships stg_payments.subscription_id",
        "stg_payments WHERE subscription_id NOT IN (SELECT subscription_id FROM stg_subscriptions)",
    ),
    ("accepted_values stg_subscriptions.status", "stg_subscriptions WHERE status NOT IN ('active', 'canceled', 'trial')"),
    (
        "accepted_values stg_payments.payment_status",
        "stg_payments WHERE payment_status NOT IN ('success', 'failed', 'refunded')",
    ),
]
_PIVOT = ", ".join(f"coalesce(max(mrr_usd) FILTER (plan_type = '{p}'), 0) AS \"{p}\"" for p in PLANS)

ORACLE = {
    "sub_stg_customers": _MODELS + "SELECT * FROM stg_customers",
    "sub_stg_subscriptions": _MODELS + "SELECT * FROM stg_subscriptions",
    "sub_stg_payments": _MODELS + "SELECT * FROM stg_payments",
    "sub_latest_subscription": _MODELS + "SELECT * FROM latest",
    "sub_dim_customers": _MODELS + "SELECT * FROM dim_customers",
    "sub_payment_agg": _MODELS + "SELECT * FROM payment_agg",
    "sub_fct_subscriptions": _MODELS + "SELECT * FROM fct_subscriptions",
    "sub_month_spine": _MODELS + "SELECT * FROM months",
    "sub_fct_mrr": _MODELS + "SELECT * FROM fct_mrr ORDER BY 1, 2",
    "sub_mrr_delta": _MODELS + """
, totals AS (SELECT month_start, CAST(sum(CAST(mrr_usd AS DECIMAL(18, 2))) AS DOUBLE) AS mrr FROM fct_mrr GROUP BY 1),
paired AS (SELECT *, lag(mrr) OVER (ORDER BY month_start) AS previous FROM totals)
SELECT month_start AS latest_month, mrr AS latest_mrr, coalesce(previous, 0) AS previous_mrr,
  coalesce((mrr - previous) / nullif(previous, 0) * 100, 0) AS delta_pct
FROM paired ORDER BY month_start DESC LIMIT 1""",
    "sub_mrr_pivot": _MODELS + f"SELECT month_start, {_PIVOT} FROM fct_mrr GROUP BY 1",
    "sub_top_plan": _MODELS + """
SELECT * FROM fct_mrr WHERE month_start = (SELECT max(month_start) FROM fct_mrr)
ORDER BY mrr_usd DESC, plan_type LIMIT 1""",
    "sub_customer_kpis": _MODELS + """
SELECT count(*) AS customers, count(*) FILTER (coalesce(is_active_subscriber, false)) AS active_customers,
  count(*) FILTER (NOT coalesce(is_active_subscriber, false)) AS churned_customers,
  CAST(count(*) FILTER (coalesce(is_active_subscriber, false)) AS DOUBLE) / count(*) * 100 AS active_rate
FROM dim_customers""",
    "sub_plan_mix": _MODELS + """
SELECT current_plan_type, count(*) AS customers FROM dim_customers WHERE is_active_subscriber GROUP BY 1
ORDER BY 2 DESC, 1""",
    "sub_revenue_by_plan": _MODELS + """
SELECT plan_type, CAST(sum(CAST(total_paid_usd AS DECIMAL(18, 2))) AS DOUBLE) AS collected_usd
FROM fct_subscriptions GROUP BY 1 ORDER BY 2 DESC, 1""",
    "sub_paid_summary": _MODELS + """
SELECT count(*) AS subscriptions, count(DISTINCT plan_type) AS plans,
  CAST(sum(CAST(total_paid_usd AS DECIMAL(18, 2))) AS DOUBLE) AS paid_usd FROM fct_subscriptions""",
    "sub_churn_rate": _MODELS + f"""
, spans AS (
  SELECT date_trunc('month', start_date) AS start_month, date_trunc('month', end_date) AS end_month,
    end_date <= {_AS_OF} AS ended
  FROM stg_subscriptions WHERE end_date IS NULL OR date_trunc('month', end_date) > date_trunc('month', start_date)
)
SELECT month_start, count(*) AS active_at_start, count(*) FILTER (ended AND end_month = month_start) AS churned,
  CAST(count(*) FILTER (ended AND end_month = month_start) AS DOUBLE) / count(*) * 100 AS churn_rate
FROM months JOIN spans ON start_month < month_start AND (end_month IS NULL OR end_month >= month_start) GROUP BY 1""",
    "sub_customer_ltv": _MODELS + """
SELECT customer_id, CAST(sum(CAST(total_paid_usd AS DECIMAL(18, 2))) AS DOUBLE) AS lifetime_value_usd,
  CAST(sum(successful_payments) AS BIGINT) AS payments
FROM fct_subscriptions GROUP BY 1""",
    "sub_scd2": _MODELS + """
, daily AS (
  SELECT * FROM stg_subscriptions
  QUALIFY row_number() OVER (PARTITION BY customer_id, start_date ORDER BY subscription_id DESC) = 1
), changes AS (
  SELECT * FROM daily
  QUALIFY lag(plan_type) OVER (PARTITION BY customer_id ORDER BY start_date) IS DISTINCT FROM plan_type
)
SELECT customer_id, plan_type, start_date AS valid_from,
  lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) AS valid_to, valid_to IS NULL AS is_current
FROM changes""",
    "sub_model_tests": _MODELS + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations, count(*) = 0 AS passed FROM {failing}"
        for name, failing in _TESTS
    ),
}
ORACLE["sub_mrr_increment"] = ORACLE["sub_fct_mrr"]
ORACLE["sub_scd2_increment"] = ORACLE["sub_scd2"]
ORACLE["sub_layers"] = _MODELS + "SELECT subscription_id, status, total_paid_usd, duration_months FROM fct_subscriptions"
ORACLE["sub_catalog"] = _MODELS + """
SELECT 'raw.raw_payments' AS name, true AS found, CAST(5 AS INTEGER) AS columns, count(*) AS rows FROM lineitem
UNION ALL SELECT 'stg_payments', true, 5, count(*) FROM stg_payments
UNION ALL SELECT 'marts.fct_subscriptions', true, 11, count(*) FROM fct_subscriptions
UNION ALL SELECT 'marts.dim_customers', true, 9, count(*) FROM dim_customers
UNION ALL SELECT 'marts.no_such_table', false, NULL, NULL"""
