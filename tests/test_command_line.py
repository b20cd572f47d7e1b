from __future__ import annotations

import json

import pytest

from millrace import schemas
from millrace.__main__ import main
from millrace.sources.warehouse import Warehouse
from tests.helpers import rows
from tests.test_readings import payload
from tests.test_sales import FILE_1
from tests.test_weblog import GOOD

AT = "2024-01-10T08:00:00Z"


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path / "out")


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_sales(spark, tmp_path, root):
    path = write(tmp_path, "sales.csv", FILE_1)
    assert main(["sales", "--input", path, "--warehouse", root]) == 0
    assert Warehouse(spark, root).version() == 1
    bad = write(tmp_path, "bad.csv", FILE_1 + "20,2024-01-01,A,a@x.example,P,C,0,5,X\n")
    assert main(["sales", "--input", bad, "--warehouse", root]) == 1
    assert main(["sales", "--input", str(tmp_path / "none.csv"), "--warehouse", root]) == 1
    assert Warehouse(spark, root).version() == 1


def test_prices(spark, tmp_path, root):
    for hour, price in ((8, 40000), (9, 41000)):
        body = json.dumps({"bitcoin": {"usd": price, "usd_market_cap": 1e12}, "solana": {"usd": 95}})
        landed = json.dumps({"payload": body, "fetched_at_utc": f"2024-01-10T0{hour}:00:00Z"})
        path = write(tmp_path, f"{hour}.json", landed + "\n")
        assert main(["prices", "--input", path, "--warehouse", root, "--keys", "bitcoin"]) == 0
    fact = Warehouse(spark, root).read("fact_price_hourly", schemas.FACT_PRICES)
    assert rows(fact, "moving_avg_3", "pct_change_from_prev") == [(40000.0, None), (40500.0, 2.5)]


def test_weblog(spark, tmp_path, root):
    path = write(tmp_path, "access.log", f"{GOOD}\nbroken\n")
    for run in ("a", "b"):
        assert main(["weblog", "--input", path, "--warehouse", root, "--run-id", run]) == 0
    summary = Warehouse(spark, root).read("pipeline_run_summary", schemas.LOG_SUMMARY)
    assert rows(summary, "run_id", "source_file", "parsed_ok", "parse_success_rate") == [("b", "access.log", 1, 50.0)]
    assert main(["weblog", "--input", path, "--warehouse", root, "--run-id", "c", "--append"]) == 0
    assert Warehouse(spark, root).read("pipeline_run_summary", schemas.LOG_SUMMARY).count() == 2


def test_readings(spark, tmp_path, root):
    landed = [{"run_id": "r", "city_name": city, "payload": payload(), "fetched_at_utc": AT} for city in ("Jakarta", "Medan")]
    path = write(tmp_path, "landed.json", "\n".join(map(json.dumps, landed)))
    assert main(["readings", "--input", path, "--warehouse", root, "--run-id", "r"]) == 0
    log = Warehouse(spark, root).read("pipeline_run_log", schemas.RUN_LOG)
    assert rows(log, "cities_requested", "cities_succeeded", "status") == [(5, 2, "partial_failure")]


def test_subscriptions(spark, tmp_path, root):
    write(tmp_path, "raw_customers.csv", "customer_id,customer_name,email,signup_date,country\n1,A,a@x.example,2024-01-01,NO\n")
    header = "subscription_id,customer_id,plan_type,start_date,end_date,monthly_price_cents,status\n"
    write(tmp_path, "raw_subscriptions.csv", header + "5,1,pro,2024-01-01,,1000,active\n")
    header = "payment_id,subscription_id,payment_date,amount_cents,status\n"
    write(tmp_path, "raw_payments.csv", header + "9,5,2024-01-01,1000,success\n")
    assert main(["subscriptions", "--input", str(tmp_path), "--as-of", "2024-02-01"]) == 0
    assert rows(spark.table("marts.fct_mrr"), "plan_type", "mrr_usd") == [("pro", 10.0)] * 2
    write(tmp_path, "raw_payments.csv", header + "9,6,2024-01-01,1000,success\n")
    assert main(["subscriptions", "--input", str(tmp_path), "--as-of", "2024-02-01"]) == 1
