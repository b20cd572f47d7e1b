from __future__ import annotations

from datetime import date

import pytest

from millrace import schemas
from millrace.plans import subscriptions as subs
from millrace.sources.files import read_seed_csv
from tests.helpers import rows

AS_OF = date(2024, 4, 15)
CUSTOMERS = "1, Ada , ADA@X.example ,2024-01-02,NO\n2,Bo,bo@x.example,,SE\n3,Cy,cy@x.example,2024-13-01,DK\n"
# 1 switched from basic to pro in February, 2 came and went, 103 ends before it starts.
SUBSCRIPTIONS = """101,1,basic,2024-01-31,2024-02-01,1000,canceled
102,1,pro,2024-02-01,,2550,active
103,2,pro,2024-03-10,2024-01-10,9900,canceled
104,2,basic,2024-01-05,2024-01-20,1000,canceled
"""
PAYMENTS = "1,101,2024-01-31,1000,success\n2,102,2024-02-01,2550,success\n3,102,2024-03-01,2550,failed\n4,102,2024-03-02,2550,refunded\n"


@pytest.fixture
def raw(spark, tmp_path):
    files = {
        "raw_customers": ("customer_id,customer_name,email,signup_date,country", CUSTOMERS, schemas.RAW_CUSTOMERS),
        "raw_subscriptions": (
            "subscription_id,customer_id,plan_type,start_date,end_date,monthly_price_cents,status",
            SUBSCRIPTIONS,
            schemas.RAW_SUBSCRIPTIONS,
        ),
        "raw_payments": ("payment_id,subscription_id,payment_date,amount_cents,status", PAYMENTS, schemas.RAW_PAYMENTS),
    }
    frames = {}
    for name, (header, text, schema) in files.items():
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{text}")
        frames[name] = read_seed_csv(spark, str(tmp_path / f"{name}.csv"), schema)
    return frames


@pytest.fixture
def models(raw):
    return subs.build_models(raw, AS_OF)


def frame(spark, *data):
    return spark.createDataFrame(
        data, "subscription_id int, plan_type string, start_date date, end_date date, monthly_price_usd double"
    )


def test_staging(models):
    assert rows(models["stg_customers"]) == [
        (1, "Ada", "ada@x.example", date(2024, 1, 2), "NO"),
        (2, "Bo", "bo@x.example", None, "SE"),
        (3, "Cy", "cy@x.example", None, "DK"),
    ]
    assert rows(models["stg_subscriptions"], "subscription_id", "end_date", "monthly_price_usd")[1] == (102, None, 25.5)
    assert rows(models["stg_payments"])[0] == (1, 101, date(2024, 1, 31), 10.0, "success")


def test_dim_customers(models):
    assert rows(models["dim_customers"], "customer_id", "current_plan_type", "is_active_subscriber") == [
        (1, "pro", True), (2, "pro", False), (3, None, None)
    ]
    kpis = subs.customer_kpis(models["dim_customers"]).first()
    assert (kpis.customers, kpis.active_customers, kpis.churned_customers) == (3, 1, 2)
    assert rows(subs.plan_mix(models["dim_customers"])) == [("pro", 1)]


def test_fct_subscriptions(models):
    facts = models["fct_subscriptions"]
    columns = ["subscription_id", "duration_months", "total_paid_usd", "successful_payments", "failed_payments"]
    assert rows(facts, *columns) == [(101, 1, 10.0, 1, 0), (102, 2, 25.5, 1, 1), (103, -2, 0.0, 0, 0), (104, 0, 0.0, 0, 0)]
    assert [tuple(r) for r in subs.revenue_by_plan(facts).collect()] == [("pro", 25.5), ("basic", 10.0)]
    assert rows(subs.paid_summary(facts)) == [(4, 2, 35.5)]


def test_fct_mrr(models):
    mrr = models["fct_mrr"]
    assert rows(mrr) == [
        (date(2024, 1, 1), "basic", 2, 20.0),
        (date(2024, 2, 1), "basic", 1, 10.0),
        (date(2024, 2, 1), "pro", 1, 25.5),
        (date(2024, 3, 1), "pro", 1, 25.5),
        (date(2024, 4, 1), "pro", 1, 25.5),
    ]
    assert subs.mrr_delta(mrr).first().asDict() == {
        "latest_month": date(2024, 4, 1), "latest_mrr": 25.5, "previous_mrr": 25.5, "delta_pct": 0.0
    }
    assert rows(subs.mrr_pivot(mrr, ["basic", "pro"]))[0] == (date(2024, 1, 1), 20.0, 0.0)
    assert rows(subs.top_plan(mrr), "plan_type") == [("pro",)]


def by_range_join(spark, subscriptions, as_of):
    """The definition, spelled out month by month."""
    subscriptions.createOrReplaceTempView("s_")
    return spark.sql(f"""
        WITH months AS (SELECT explode(sequence((SELECT trunc(min(start_date), 'month') FROM s_),
          trunc(DATE '{as_of}', 'month'), interval 1 month)) AS m)
        SELECT m AS month_start, plan_type, count(DISTINCT subscription_id) AS active_subscriptions,
          round(sum(monthly_price_usd), 2) AS mrr_usd
        FROM months JOIN s_ ON trunc(start_date, 'month') <= m
          AND (end_date IS NULL OR trunc(end_date, 'month') >= m) GROUP BY 1, 2""")


def test_mrr_equals_the_range_join_on_awkward_input(spark):
    """Repeated ids with overlapping and separate spans, null prices, plans and ids, ends in the future, gaps."""
    d = date
    df = frame(
        spark,
        (1, "a", d(2023, 1, 5), d(2023, 3, 1), 10.1), (1, "a", d(2023, 2, 5), d(2023, 6, 1), 10.2),
        (1, "a", d(2023, 2, 7), d(2023, 2, 8), 0.1), (1, "a", d(2023, 9, 5), d(2023, 10, 1), 10.2),
        (1, "b", d(2023, 1, 5), None, None), (2, "b", d(2023, 3, 5), d(2023, 3, 6), 0.3),
        (3, None, d(2023, 3, 5), d(2030, 1, 1), 1.0), (None, "c", d(2023, 5, 1), d(2023, 5, 2), 2.0),
        (4, "c", d(2023, 8, 1), d(2023, 7, 1), 2.0), (5, "c", None, None, 2.0), (6, "c", d(2025, 1, 1), None, 2.0),
        (7, "d", d(2023, 12, 1), None, 0.1), (8, "d", d(2023, 12, 31), None, 0.2),
    )
    as_of = d(2024, 2, 10)
    assert rows(subs.fct_mrr(df, as_of)) == rows(by_range_join(spark, df, as_of))


def test_mrr_without_subscriptions(spark):
    mrr = subs.fct_mrr(frame(spark, (1, "a", None, None, 1.0)), AS_OF)
    assert mrr.count() == 0
    assert subs.mrr_delta(mrr).first().delta_pct == 0.0


def test_churn_rate(models):
    assert rows(subs.churn_rate(models["stg_subscriptions"], AS_OF)) == [
        (date(2024, 2, 1), 1, 1, 100.0), (date(2024, 3, 1), 1, 0, 0.0), (date(2024, 4, 1), 1, 0, 0.0)
    ]


def test_lifetime_value(models):
    assert rows(subs.customer_ltv(models["stg_subscriptions"], models["stg_payments"])) == [(1, 35.5, 2), (2, 0.0, 0)]


def test_plan_history(spark):
    data = [
        (1, 7, "a", date(2024, 1, 1)), (2, 7, "a", date(2024, 2, 1)), (3, 7, "b", date(2024, 3, 1)),
        (4, 7, "c", date(2024, 3, 1)), (5, 7, "a", date(2024, 4, 1)), (6, 7, "z", None), (7, 8, None, date(2024, 1, 1)),
    ]
    df = spark.createDataFrame(data, "subscription_id int, customer_id int, plan_type string, start_date date")
    assert rows(subs.plan_history(df)) == [
        (7, "a", date(2024, 1, 1), date(2024, 3, 1), False),
        (7, "a", date(2024, 4, 1), None, True),
        (7, "c", date(2024, 3, 1), date(2024, 4, 1), False),
        (8, None, date(2024, 1, 1), None, True),
    ]


def test_declarative_tests(models):
    report = subs.check_models(models)
    assert report.count() == 19 and report.filter("NOT passed").count() == 0


def test_declarative_tests_find_what_is_wrong(raw):
    payments = raw["raw_payments"]
    raw["raw_payments"] = payments.unionByName(payments.selectExpr(
        "payment_id", "subscription_id + 1000 AS subscription_id", "payment_date", "amount_cents", "'odd' AS status"
    ))
    failed = subs.check_models(subs.build_models(raw, AS_OF)).filter("NOT passed")
    assert rows(failed, "check_name", "violations") == [
        ("accepted_values stg_payments.payment_status", 4),
        ("relationships stg_payments.subscription_id", 4),
        ("unique stg_payments.payment_id", 4),
    ]


def test_layers(spark, raw):
    stored = subs.save_models(raw, AS_OF)
    assert spark.catalog.tableExists("raw.raw_payments") and spark.catalog.tableExists("marts.fct_mrr")
    assert rows(stored["fct_mrr"]) == rows(subs.build_models(raw, AS_OF)["fct_mrr"])
    assert spark.table("stg_customers").count() == 3
