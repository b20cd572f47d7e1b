"""Subscription staging models, marts and revenue metrics.

``as_of`` takes the place of the current date everywhere, so a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import as_month, cents_to_dollars, months_crossed, percent, tolerant_date
from millrace.functions.money import exact_sum
from millrace.operators.quality import model_report, relationships, run_tests
from millrace.operators.rows import compute_once, frequency, keep_latest, top_k
from millrace.session import write_once
from millrace.sources.warehouse import save_layer

# Fixed values.
SUBSCRIPTION_STATUSES = ["active", "canceled", "trial"]
PAYMENT_STATUSES = ["success", "failed", "refunded"]


# Staging: rename and type, one to one with the source. Ids are 64 bits wide, so they last. ----------------------------


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.trim("customer_name").alias("customer_name"),
        F.lower(F.trim("email")).alias("email"),
        tolerant_date(F.col("signup_date")).alias("signup_date"),
        "country",
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("subscription_id").cast("bigint").alias("subscription_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "plan_type",
        tolerant_date(F.col("start_date")).alias("start_date"),
        tolerant_date(F.col("end_date")).alias("end_date"),
        cents_to_dollars(F.col("monthly_price_cents")).alias("monthly_price_usd"),
        "status",
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("payment_id").cast("bigint").alias("payment_id"),
        F.col("subscription_id").cast("bigint").alias("subscription_id"),
        tolerant_date(F.col("payment_date")).alias("payment_date"),
        cents_to_dollars(F.col("amount_cents")).alias("amount_usd"),
        F.col("status").alias("payment_status"),
    )


# Marts --------------------------------------------------------------------------------------------------------------


def latest_subscription(subscriptions: DataFrame) -> DataFrame:
    """Newest subscription per customer; on equal start dates the higher id."""
    return keep_latest(subscriptions, ["customer_id"], ["start_date", "subscription_id"])


def dim_customers(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Customers with their current plan; the flag is null for customers who never subscribed."""
    current = latest_subscription(subscriptions).select(
        "customer_id",
        F.col("plan_type").alias("current_plan_type"),
        F.col("status").alias("current_subscription_status"),
        F.col("monthly_price_usd").alias("current_monthly_price_usd"),
        (F.col("status") == "active").alias("is_active_subscriber"),
    )
    return customers.join(current, "customer_id", "left")


def payment_totals(payments: DataFrame, key: str = "subscription_id") -> DataFrame:
    """Paid sum and payment counts per key; refunds count in neither."""
    paid, failed = F.col("payment_status") == "success", F.col("payment_status") == "failed"
    return payments.groupBy(key).agg(
        exact_sum(F.when(paid, F.col("amount_usd")).otherwise(0.0)).alias("total_paid_usd"),
        F.count_if(paid).alias("successful_payments"),
        F.count_if(failed).alias("failed_payments"),
    )


def fct_subscriptions(subscriptions: DataFrame, payments: DataFrame, as_of: date) -> DataFrame:
    """Subscription grain with duration and payment totals; payments shrink to their key before the join."""
    end = F.coalesce("end_date", F.lit(as_of))
    return subscriptions.join(payment_totals(payments), "subscription_id", "left").select(
        *subscriptions.columns,
        months_crossed(F.col("start_date"), end).alias("duration_months"),
        F.coalesce("total_paid_usd", F.lit(0.0)).alias("total_paid_usd"),
        F.coalesce("successful_payments", F.lit(0)).alias("successful_payments"),
        F.coalesce("failed_payments", F.lit(0)).alias("failed_payments"),
    )


def _next_month(month: Column) -> Column:
    return F.add_months(month, 1)


def _running_by_month(changes: DataFrame, by: Sequence[str], totals: Sequence[str], as_of: date) -> DataFrame:
    """Monthly levels from monthly changes.

    ``changes`` holds one row per group and month in which something changed, so what the window sorts is bounded by the
    calendar. A level lasts until the month before the next change, or until the month of ``as_of``.
    """
    in_time = Window.partitionBy(*by).orderBy("month")
    last = as_month(F.lit(as_of))
    return (
        changes.withColumns(
            {t: F.sum(t).over(in_time.rowsBetween(Window.unboundedPreceding, 0)) for t in totals}
            | {"_until": F.coalesce(F.add_months(F.lead("month").over(in_time), -1), last)}
        )
        .withColumn("_until", F.least("_until", last))
        .filter(F.col("month") <= F.col("_until"))
        .withColumn("month_start", F.explode(F.expr("sequence(month, _until, interval 1 month)")))
        .drop("month", "_until")
    )


def fct_mrr(subscriptions: DataFrame, as_of: date) -> DataFrame:
    """Active subscriptions and monthly recurring revenue per month and plan.

    A subscription counts in every month from its start to its end (both included; an open one to ``as_of``), whatever
    its status. Months without one have no row. Instead of one row per subscription and month, each stretch of
    activity adds to its first month and subtracts from the month after its last; the levels are running sums of these
    changes, of which there are at most one per plan and month.

    Prices are summed in whole cents, so adding and subtracting leaves no residue. Rows repeating a subscription id
    count once per month but add each of their prices.
    """
    spans = _spans(subscriptions, as_month(F.col("start_date")), as_of).select(
        "subscription_id", "plan_type", "monthly_price_usd", "lo", "hi"
    )
    price = F.floor(F.col("monthly_price_usd") * 100 + 0.5)
    priced = F.col("monthly_price_usd").isNotNull().cast("bigint")
    amounts = _span_changes(
        spans, ["plan_type"], {"cents": F.coalesce(price, F.lit(0)), "priced": priced, "rows": F.lit(1)}
    )
    heads = _span_changes(_merged_spans(spans), ["plan_type"], {"active": F.lit(1)})
    totals = ["cents", "priced", "rows", "active"]
    changes = (
        amounts.unionByName(heads, allowMissingColumns=True)
        .groupBy("plan_type", "month")
        .agg(*[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in totals])
    )
    return (
        _running_by_month(changes, ["plan_type"], totals, as_of)
        .filter(F.col("rows") > 0)
        .select(
            "month_start",
            "plan_type",
            F.col("active").alias("active_subscriptions"),
            F.when(F.col("priced") > 0, F.round(F.col("cents") / 100, 2)).alias("mrr_usd"),
        )
    )


def _spans(subscriptions: DataFrame, first: Column, as_of: date) -> DataFrame:
    """Subscriptions with the first and last month they count in, ``lo`` and ``hi``, without those that never do."""
    this_month = as_month(F.lit(as_of))
    last = F.least(as_month(F.coalesce("end_date", F.lit(as_of))), this_month)
    months = F.struct(first.alias("lo"), last.alias("hi"))
    return compute_once(subscriptions, "_span", months).select("*", "_span.*").filter(F.col("lo") <= F.col("hi"))


def _span_changes(spans: DataFrame, by: Sequence[str], amounts: dict[str, Column]) -> DataFrame:
    """Per group and month: what starts minus what ended in the month before. Summed map-side before any shuffle."""
    both = F.array(
        F.struct(F.col("lo").alias("month"), F.lit(1).alias("sign")),
        F.struct(_next_month(F.col("hi")).alias("month"), F.lit(-1).alias("sign")),
    )
    return (
        spans.select(*by, *[a.alias(name) for name, a in amounts.items()], F.inline(both))
        .groupBy(*by, "month")
        .agg(*[F.sum(F.col(name) * F.col("sign")).alias(name) for name in amounts])
    )


def _merged_spans(spans: DataFrame) -> DataFrame:
    """Stretches of activity per plan and subscription id, overlaps merged.

    With unique ids this changes nothing. Collecting the distinct spans first (map-side, then per id) bounds a repeated
    id to one row per pair of months, and leaves the rows where the window wants them: one shuffle serves both.
    """
    key = ["plan_type", "subscription_id"]
    distinct = (
        spans.filter(F.col("subscription_id").isNotNull())
        .groupBy(*key)
        .agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
        .select(*key, F.inline("_spans"))
    )
    in_time = Window.partitionBy(*key).orderBy("lo", "hi")
    before = F.max("hi").over(in_time.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("lo") > before)).cast("int")
    numbered = distinct.withColumn("_begins", begins).withColumn(
        "_stretch", F.sum("_begins").over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(*key, "_stretch").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


# Metrics over the marts -----------------------------------------------------------------------------------------------


def mrr_delta(mrr: DataFrame) -> DataFrame:
    """Newest month's revenue against the previous month that has any; 0 percent without one."""
    newest = top_k(mrr.groupBy("month_start").agg(exact_sum("mrr_usd").alias("mrr")), 2, F.desc("month_start"))
    return (
        newest.agg(
            F.max("month_start").alias("latest_month"),
            F.max_by("mrr", "month_start").alias("latest_mrr"),
            F.min_by("mrr", "month_start").alias("_earlier"),
            F.count(F.lit(1)).alias("_n"),
        )
        .withColumn("previous_mrr", F.when(F.col("_n") > 1, F.col("_earlier")).otherwise(0.0))
        .withColumn("delta_pct", percent(F.col("latest_mrr") - F.col("previous_mrr"), F.col("previous_mrr")))
        .drop("_earlier", "_n")
    )


def mrr_pivot(mrr: DataFrame, plans: Sequence[str]) -> DataFrame:
    """Months by plans; 0 where a plan has no revenue. The plans are given, which saves a pass to find them."""
    return mrr.groupBy("month_start").pivot("plan_type", list(plans)).agg(exact_sum("mrr_usd")).fillna(0.0, list(plans))


def top_plan(mrr: DataFrame) -> DataFrame:
    """The plan with the highest revenue in the newest month; on a tie the first name."""
    priced = mrr.filter(F.col("mrr_usd").isNotNull())
    return top_k(priced, 1, F.desc("month_start"), F.desc("mrr_usd"), F.asc("plan_type"))


def customer_kpis(customers: DataFrame) -> DataFrame:
    """Active and churned customers; one without any subscription counts as churned."""
    active = F.coalesce("is_active_subscriber", F.lit(False))
    return customers.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(active).alias("active_customers"),
        F.count_if(~active).alias("churned_customers"),
    ).withColumn("active_rate", percent(F.col("active_customers"), F.col("customers")))


def plan_mix(customers: DataFrame) -> DataFrame:
    """Current plans of the active customers."""
    return frequency(customers.filter("is_active_subscriber"), "current_plan_type", "customers")


def revenue_by_plan(facts: DataFrame) -> DataFrame:
    return facts.groupBy("plan_type").agg(exact_sum("total_paid_usd").alias("collected_usd")).orderBy(
        F.desc("collected_usd"), "plan_type"
    )


def paid_summary(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.count_distinct("plan_type").alias("plans"),
        exact_sum("total_paid_usd").alias("paid_usd"),
    )


def churn_rate(subscriptions: DataFrame, as_of: date) -> DataFrame:
    """Per month: subscriptions active at its start, those of them that ended in it, and their share in percent.

    Active at the start of a month: begun in an earlier month and not ended before this one.
    """
    spans = _spans(subscriptions, _next_month(as_month(F.col("start_date"))), as_of)
    ended = spans.filter(F.col("end_date") <= F.lit(as_of))
    leaving = ended.groupBy(F.col("hi").alias("month_start")).agg(F.count(F.lit(1)).alias("churned"))
    # No partition columns: the rows below are monthly totals.
    levels = _running_by_month(_span_changes(spans, [], {"active_at_start": F.lit(1)}), [], ["active_at_start"], as_of)
    return (
        levels.filter(F.col("active_at_start") > 0)
        .join(leaving, "month_start", "left")
        .select("month_start", "active_at_start", F.coalesce("churned", F.lit(0)).alias("churned"))
        .withColumn("churn_rate", percent(F.col("churned"), F.col("active_at_start")))
    )


def customer_ltv(subscriptions: DataFrame, payments: DataFrame) -> DataFrame:
    """Successful payments per customer over all their subscriptions; 0 for customers who never paid."""
    paid = payment_totals(payments)
    owners = subscriptions.select("subscription_id", "customer_id")
    return (
        owners.join(paid, "subscription_id", "left")
        .groupBy("customer_id")
        .agg(
            F.coalesce(exact_sum("total_paid_usd"), F.lit(0.0)).alias("lifetime_value_usd"),
            F.coalesce(F.sum("successful_payments"), F.lit(0)).alias("payments"),
        )
    )


def plan_history(subscriptions: DataFrame) -> DataFrame:
    """Type 2 history of each customer's plan at day grain: ``valid_from``, ``valid_to`` (excluded, null = current).

    Of several subscriptions starting on one day the highest id counts. That first step leaves at most one row per
    customer and day, so the windows after it are bounded by the calendar.
    """
    daily = (
        subscriptions.filter(F.col("start_date").isNotNull())
        .groupBy("customer_id", "start_date")
        .agg(F.max_by("plan_type", "subscription_id").alias("plan_type"))
    )
    in_time = Window.partitionBy("customer_id").orderBy("start_date")
    changed = daily.withColumn("_before", F.lag(F.struct("plan_type")).over(in_time)).filter(
        F.col("_before").isNull() | ~F.col("_before.plan_type").eqNullSafe(F.col("plan_type"))
    )
    return changed.select(
        "customer_id",
        "plan_type",
        F.col("start_date").alias("valid_from"),
        F.lead("start_date").over(in_time).alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())


# Build and test -------------------------------------------------------------------------------------------------------


def build_models(raw: dict[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """All models by name, from the raw tables ``raw_customers``, ``raw_subscriptions`` and ``raw_payments``."""
    customers = stg_customers(raw["raw_customers"])
    subscriptions = stg_subscriptions(raw["raw_subscriptions"])
    payments = stg_payments(raw["raw_payments"])
    return {
        "stg_customers": customers,
        "stg_subscriptions": subscriptions,
        "stg_payments": payments,
        "dim_customers": dim_customers(customers, subscriptions),
        "fct_subscriptions": fct_subscriptions(subscriptions, payments, as_of),
        "fct_mrr": fct_mrr(subscriptions, as_of),
    }


def save_models(raw: dict[str, DataFrame], as_of: date, location: str | None = None) -> dict[str, DataFrame]:
    """Seeds to ``raw``, staging as views over them, marts to ``marts``; returns the models as stored.

    ``location`` is the folder of layers that are new to the catalog, if it is not the session's.
    """
    spark = next(iter(raw.values())).sparkSession
    for name, df in raw.items():
        save_layer(df, "raw", name, location)
    models = build_models({name: spark.table(f"raw.{name}") for name in raw}, as_of)
    for name, df in models.items():
        save_layer(df, "staging" if name.startswith("stg_") else "marts", name, location)
    return {name: spark.table(name if name.startswith("stg_") else f"marts.{name}") for name in models}


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """The declarative tests of all models: violations per test. Each model is computed and stored once, then read once, and
    once per parent test."""
    m = {name: write_once(df, f"model-{name}") for name, df in models.items()}
    reports = [
        model_report(m["stg_customers"], "stg_customers", "customer_id", ["customer_id", "email"]),
        model_report(
            m["stg_subscriptions"], "stg_subscriptions", "subscription_id", ["subscription_id", "customer_id"],
            {"status": SUBSCRIPTION_STATUSES},
        ),
        model_report(
            m["stg_payments"], "stg_payments", "payment_id", ["payment_id", "subscription_id"],
            {"payment_status": PAYMENT_STATUSES},
        ),
        model_report(m["dim_customers"], "dim_customers", "customer_id", ["customer_id"]),
        model_report(
            m["fct_subscriptions"], "fct_subscriptions", "subscription_id", ["subscription_id", "total_paid_usd"]
        ),
        model_report(m["fct_mrr"], "fct_mrr", required=["mrr_usd"]),
        run_tests(
            {
                "relationships stg_subscriptions.customer_id": relationships(
                    m["stg_subscriptions"], "customer_id", m["stg_customers"], "customer_id"
                ),
                "relationships stg_payments.subscription_id": relationships(
                    m["stg_payments"], "subscription_id", m["stg_subscriptions"], "subscription_id"
                ),
            }
        ),
    ]
    return reduce(DataFrame.unionAll, reports)
