from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import DataQualityError
from millrace.plans import sales
from millrace.sources.files import MissingColumn, read_sales_csv
from tests.helpers import rows, shuffled

HEADER = "order_id,order_date,customer_name,customer_email,product_name,category,quantity,unit_price,city\n"
# Two customers, one unnamed at first; two shirts at different prices; an order sent twice.
FILE_1 = HEADER + """10,2024-03-01,,mia@x.example, Shirt ,Clothes,2,50,Bern
11,02/03/2024,Noah Berg,noah@x.example,Lamp,Home,,80.5,Basel
12,2024-3-2,Mia Lang,mia@x.example,Shirt,Clothes,1,60,Bern
10,2024-03-01,Mia Lang,mia@x.example,Shirt,Clothes,9,50,Bern
"""
FILE_2 = HEADER + """13,05/03/2024,Noah Berg, noah@x.example ,Lamp,Home, 3 ,80.5,NA
"""


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FILE_1)
    (tmp_path / "b.csv").write_text(FILE_2)
    return read_sales_csv(spark, str(tmp_path / "*.csv"))


def load(warehouse, raw, dense=False):
    sales.load_star(warehouse, raw, dense=dense)
    return {
        "customers": warehouse.read("dim_customer", schemas.DIM_CUSTOMER),
        "products": warehouse.read("dim_product", schemas.DIM_PRODUCT),
        "dates": warehouse.read("dim_date", schemas.DIM_DATE),
        "fact": warehouse.read("fact_sales", schemas.FACT_SALES),
    }


def test_columns_are_found_by_name_and_quoted_fields_may_hold_anything(spark, tmp_path):
    path = tmp_path / "shuffled.csv"
    path.write_text(
        "city,unit_price,order_id,extra,order_date,customer_name,customer_email,product_name,category,quantity\n"
        'Bern,5,7,x,2024-01-01,"Ann ""A, B"" C",a@x.example,"two\nlines",C,1\nBasel,6,8,y,2024-01-02,Bo,b@x.example,P\n'
    )
    got = read_sales_csv(spark, str(path)).orderBy("seq").collect()
    assert [(r.order_id, r.city, r.customer_name, r.product_name, r.quantity) for r in got] == [
        ("7", "Bern", 'Ann "A, B" C', "two\nlines", "1"), ("8", "Basel", "Bo", "P", None)
    ]


def test_a_missing_column_fails(spark, tmp_path):
    (tmp_path / "short.csv").write_text("order_id,order_date\n1,2024-01-01\n")
    with pytest.raises(MissingColumn, match="quantity"):
        read_sales_csv(spark, str(tmp_path / "short.csv"))


def test_scan_reads_text_in_file_order(raw):
    assert dict(raw.dtypes)["quantity"] == "string"
    assert [r.order_id for r in raw.orderBy("seq").collect()] == ["10", "11", "12", "10", "13"]
    assert raw.filter("order_id = 13").first().city is None


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_sales_csv(spark, str(tmp_path / "none.csv"))


def test_cleaning(raw):
    clean = sales.clean_sales(raw)
    assert rows(clean, "order_id", "order_date", "customer_name", "product_name", "quantity", "total_amount") == [
        (10, date(2024, 3, 1), "Unknown Customer", "Shirt", 2, 100.0),
        (11, date(2024, 3, 2), "Noah Berg", "Lamp", 1, 80.5),
        (12, date(2024, 3, 2), "Mia Lang", "Shirt", 1, 60.0),
        (13, date(2024, 3, 5), "Noah Berg", "Lamp", 3, 241.5),
    ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_the_first_of_two_equal_ids_stays(raw, partitions):
    clean = sales.clean_sales(raw.repartition(partitions))
    assert clean.filter("order_id = 10").first().quantity == 2


def test_hashed_keys_fit_together(warehouse, raw):
    star = load(warehouse, raw)
    joined = star["fact"].join(star["customers"], "customer_id").join(star["products"].drop("unit_price"), "product_id")
    assert rows(joined, "order_id", "customer_email", "product_name", "unit_price") == [
        (10, "mia@x.example", "Shirt", 50.0),
        (11, "noah@x.example", "Lamp", 80.5),
        (12, "mia@x.example", "Shirt", 60.0),
        (13, "noah@x.example", "Lamp", 80.5),
    ]


def test_a_shared_hash_stops_the_load(warehouse, raw, monkeypatch):
    monkeypatch.setattr(sales, "hashed_key", lambda *key: F.lit(7).cast("bigint"))
    with pytest.raises(DataQualityError, match="customer_id is not shared"):
        load(warehouse, raw)
    assert warehouse.version() == 0


def test_star(warehouse, raw):
    star = load(warehouse, raw, dense=True)
    assert rows(star["customers"]) == [
        (1, "Unknown Customer", "mia@x.example", "Bern"),
        (2, "Noah Berg", "noah@x.example", "Basel"),
    ]
    assert rows(star["products"]) == [
        (1, "Shirt", "Clothes", 50.0), (2, "Lamp", "Home", 80.5), (3, "Shirt", "Clothes", 60.0)
    ]
    assert rows(star["dates"])[0] == (20240301, date(2024, 3, 1), 2024, 3, 1, "Friday")
    assert rows(star["fact"]) == [
        (10, 20240301, 1, 1, 2, 50.0, 100.0),
        (11, 20240302, 2, 2, 1, 80.5, 80.5),
        (12, 20240302, 1, 3, 1, 60.0, 60.0),
        (13, 20240305, 2, 2, 3, 80.5, 241.5),
    ]


def test_reports(warehouse, raw):
    star = load(warehouse, raw)
    fact, products = star["fact"], star["products"]
    assert [tuple(r) for r in sales.revenue_by_category(fact, products).collect()] == [("Home", 322.0, 2), ("Clothes", 160.0, 2)]
    top = sales.top_customers(fact, star["customers"], 1).select("customer_name", "city", "total_spent", "total_orders")
    assert rows(top) == [("Noah Berg", "Basel", 322.0, 2)]
    assert [r.daily_revenue for r in sales.daily_revenue(fact, star["dates"]).collect()] == [100.0, 140.5, 241.5]
    assert [tuple(r) for r in sales.best_sellers(fact, products).collect()] == [("Lamp", 4, 322.0), ("Shirt", 3, 160.0)]
    assert rows(sales.top_products(fact, products, 1), "position", "product_name") == [(1, "Lamp")]
    assert sales.sales_kpis(fact, products).first().asDict() == {
        "total_revenue": 482.0, "total_orders": 4, "total_units": 7, "best_category": "Home",
        "date_start": date(2024, 3, 1), "date_end": date(2024, 3, 5), "avg_order_value": 120.5,
    }
    empty = sales.sales_kpis(fact.limit(0), products).first()
    assert (empty.total_orders, empty.avg_order_value, empty.best_category) == (0, 0.0, None)


@pytest.mark.parametrize(
    "line, check",
    [
        ("20,31/02/2024,A,a@x.example,P,C,1,5,X", "order_date is not null"),
        ("20,,A,a@x.example,P,C,1,5,X", "order_date is not null"),
        ("20,2024-01-01,A,a@x.example,P,C,0,5,X", "quantity > 0"),
        ("20,2024-01-01,A,a@x.example,P,C,3.0,5,X", "quantity > 0"),
        ("20,2024-01-01,A,a@x.example,P,C,1,0,X", "unit_price > 0"),
        ("20,2024-01-01,A,a@x.example,P,C,1,,X", "unit_price > 0"),
        ("20,2024-01-01,A,  ,P,C,1,5,X", "customer_email is not empty"),
        ("x1,2024-01-01,A,a@x.example,P,C,1,5,X", "order_id is not null"),
        ("020,2024-01-01,A,a@x.example,P,C,1,5,X\n20,2024-01-01,A,a@x.example,P,C,1,5,X", "order_id is unique"),
    ],
)
def test_a_bad_row_stops_the_load(spark, warehouse, tmp_path, line, check):
    path = tmp_path / "bad.csv"
    path.write_text(FILE_1 + line + "\n")
    with pytest.raises(DataQualityError, match=check):
        sales.load_star(warehouse, read_sales_csv(spark, str(path)))
    assert warehouse.version() == 0


def test_reload_replaces_the_star(spark, warehouse, raw, tmp_path):
    load(warehouse, raw)
    later = load(warehouse, raw.filter(F.col("order_id") == "11"))
    assert rows(later["fact"], "order_id") == [(11,)] and later["customers"].count() == 1


def test_rows_are_shuffled_with_dates_and_numbers_not_their_text(spark, raw):
    (schema,) = shuffled(sales.clean_sales(raw))
    assert "order_id:string,order_date:date" in schema and "quantity:bigint" in schema and "unit_price:double" in schema
    assert "total_amount" not in schema


def test_the_order_may_take_raw_columns_that_cleaning_changes(spark):
    names = HEADER.strip().split(",")
    lines = [("1", day, " A", "a@x", "p", "c", quantity, "2", "city") for day, quantity in (("2024-01-02", "5"), ("03/01/2024", "10"), ("2024-01-01", "9"))]
    raw = spark.createDataFrame(lines, [*names])
    first = [sales.clean_sales(raw, seq).first() for seq in (["order_date"], ["quantity"], [F.col("quantity").cast("int")])]
    assert [(r.order_date.day, r.quantity) for r in first] == [(3, 10), (3, 10), (2, 5)]
    assert first[0].asDict().keys() == {*names, "total_amount"}
