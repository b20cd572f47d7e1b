"""Dirty sales rows to a star schema, and the questions asked of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import date_key, default_if_blank, parse_mixed_date, ratio, real_number, strip_all, whole_number
from millrace.functions.money import amount, exact_sum, units
from millrace.operators.keys import dense_ids, hashed_key, key_collisions, lookup_key
from millrace.operators.quality import Check, enforce, gate_report, not_positive
from millrace.operators.rows import keep_first, top_k
from millrace.session import own_scratch, write_once
from millrace.sources.warehouse import Warehouse

TEXT_COLUMNS = ["customer_name", "customer_email", "product_name", "category", "city"]
CLEAN_COLUMNS = [
    "order_id", "order_date", "customer_name", "customer_email", "product_name", "category",
    "quantity", "unit_price", "city", "total_amount",
]


def gate_checks() -> list[Check]:
    """What a cleaned table must satisfy before anything is loaded.

    Text that could not be converted is null by now and so breaks the rule of its column.
    """
    return [
        Check("order_id is not null", F.col("order_id").isNull()),
        Check("quantity > 0", not_positive("quantity")),
        Check("unit_price > 0", not_positive("unit_price")),
        Check("customer_email is not empty", F.col("customer_email") == ""),
        Check("order_date is not null", F.col("order_date").isNull()),
    ]


def clean_text(raw: DataFrame) -> DataFrame:
    """Null to empty, white space stripped, for the text columns."""
    return raw.withColumns({c: strip_all(F.coalesce(c, F.lit(""))) for c in TEXT_COLUMNS})


def first_orders(raw: DataFrame, seq: Sequence[Column | str] = ("seq",)) -> DataFrame:
    """One row per order id, compared as the text that arrived; the first one stays."""
    return keep_first(raw, ["order_id"], seq)


def typed(raw: DataFrame) -> DataFrame:
    """Dates, defaults and numbers. Values that cannot be converted become null for the gate to find."""
    return numbered(converted(raw))


def converted(raw: DataFrame) -> DataFrame:
    """All of it but the order id and the amount that follows from other columns."""
    return raw.withColumns(
        {
            "order_date": parse_mixed_date(F.col("order_date")),
            "customer_name": default_if_blank(F.col("customer_name"), "Unknown Customer"),
            "quantity": whole_number(F.col("quantity"), default="1"),
            "unit_price": real_number(strip_all(F.col("unit_price"))),
        }
    )


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"order_id": whole_number(F.col("order_id")), "total_amount": F.col("quantity") * F.col("unit_price")})


def clean_sales(raw: DataFrame, seq: Sequence[Column | str] = ("seq",)) -> DataFrame:
    """The whole cleaning step; keeps the ingest-order columns for the dimensions.

    Repeated orders are recognised by their raw id. Dates and numbers are narrower than their text, so rows are cleaned before
    the shuffle that brings repeated ones together; ids, and amounts that follow from other columns, come after it. What the
    order takes from columns that are cleaned is kept as it arrived.
    """
    kept = {c for c in raw.columns if c not in CLEAN_COLUMNS or c == "order_id"}
    arrived = {f"_seq{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(seq) if not isinstance(c, str) or c not in kept}
    order = [f"_seq{i}" if f"_seq{i}" in arrived else c for i, c in enumerate(seq)]
    narrow = raw.withColumns(arrived) if arrived else raw
    return narrow.transform(clean_text).transform(converted).transform(first_orders, order).drop(*arrived).transform(numbered)


def sales_gate(clean: DataFrame) -> DataFrame:
    return gate_report(clean, gate_checks(), unique_key="order_id")


# Star schema -----------------------------------------------------------------------------------------------------


CUSTOMER_KEY = ["customer_email"]
PRODUCT_KEY = ["product_name", "unit_price"]


def dim_customer(clean: DataFrame, seq: Sequence[Column | str] = ("seq",), dense: bool = False) -> DataFrame:
    """One row per email. The first row names the customer, even if a later one knows better."""
    return _dimension(clean, CUSTOMER_KEY, ["customer_name", "customer_email", "city"], "customer_id", seq, dense)


def dim_product(clean: DataFrame, seq: Sequence[Column | str] = ("seq",), dense: bool = False) -> DataFrame:
    """One row per name and price, so a new price is a new product."""
    return _dimension(clean, PRODUCT_KEY, ["product_name", "category", "unit_price"], "product_id", seq, dense)


def _dimension(
    clean: DataFrame, natural_key: list[str], columns: list[str], id_col: str, seq: Sequence[Column | str], dense: bool
) -> DataFrame:
    """The first row per natural key. Its id is a hash of the key, which needs no further shuffle and no look-up later, or
    with ``dense`` its place in the order of first appearance, which needs both."""
    order = [F.col(c) if isinstance(c, str) else c for c in seq]
    first_seen = keep_first(clean.select(*columns, F.struct(*order).alias("_seq")), natural_key, ["_seq"])
    if dense:
        return dense_ids(first_seen, id_col, ["_seq", *natural_key]).select(id_col, *columns)
    return first_seen.select(hashed_key(*natural_key).alias(id_col), *columns)


def dim_date(clean: DataFrame) -> DataFrame:
    """The dates that occur."""
    day = F.col("full_date")
    return clean.select(F.col("order_date").alias("full_date")).distinct().select(
        date_key(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    )


def fact_sales(clean: DataFrame, customers: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Order grain with the keys of the three dimensions. Hashed keys and the date key need no look-up; dimensions with
    dense ids are given."""
    keyed = clean
    for dim, natural_key, id_col in ((customers, CUSTOMER_KEY, "customer_id"), (products, PRODUCT_KEY, "product_id")):
        if dim is None:
            keyed = keyed.withColumn(id_col, hashed_key(*natural_key))
        else:
            keyed = lookup_key(keyed, dim, natural_key, id_col)
    return keyed.select(
        "order_id",
        date_key(F.col("order_date")).alias("date_id"),
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        "total_amount",
    )


def load_star(warehouse: Warehouse, raw: DataFrame, seq: Sequence[Column | str] = ("seq",), dense: bool = False) -> int:
    """Clean, gate, build and publish all four tables with one commit. Nothing is published if a gate fails.

    Keys are hashed; that no two natural keys share one is part of the gate. ``dense`` numbers them instead.
    """
    with own_scratch(warehouse.spark):
        clean = write_once(clean_sales(raw, seq), "clean-sales", compression="zstd")
        enforce(sales_gate(clean))
        customers = warehouse.replace("dim_customer", dim_customer(clean, seq, dense))
        products = warehouse.replace("dim_product", dim_product(clean, seq, dense))
        if dense:
            fact = warehouse.replace("fact_sales", fact_sales(clean, customers.rows, products.rows))
            enforce(gate_report(fact.rows, [Check("product_id is found", F.col("product_id").isNull())]))
        else:
            for dim, id_col, natural_key in ((customers, "customer_id", CUSTOMER_KEY), (products, "product_id", PRODUCT_KEY)):
                shared = key_collisions(dim.rows, id_col, natural_key)
                enforce(gate_report(shared, [Check(f"{id_col} is not shared", F.col("natural_keys") > 1)]))
            fact = warehouse.replace("fact_sales", fact_sales(clean))
        return warehouse.commit(customers, products, warehouse.replace("dim_date", dim_date(clean)), fact)


# Reports ---------------------------------------------------------------------------------------------------------
# Each one totals the fact per dimension key first. Only these totals, one row per key, meet the dimension, so a best
# seller holding a third of the sales shrinks before the shuffle.


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_id").agg(
        F.sum(units("total_amount")).alias("revenue"), F.count("order_id").alias("orders")
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(amount(F.sum("revenue")).alias("total_revenue"), F.sum("orders").alias("total_orders"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_customers(fact: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    """Totals per customer id; only the winners need their names."""
    # The inner join of the question drops sales without a known customer before the ranking.
    totals = (
        fact.groupBy("customer_id")
        .agg(exact_sum("total_amount").alias("total_spent"), F.count("order_id").alias("total_orders"))
        .join(customers.select("customer_id", "customer_name", "city"), "customer_id")
    )
    return top_k(totals, k, F.desc("total_spent"), F.asc("customer_id"))


def daily_revenue(fact: DataFrame, dates: DataFrame) -> DataFrame:
    per_day = fact.groupBy("date_id").agg(exact_sum("total_amount").alias("daily_revenue"))
    return (
        per_day.join(dates.select("date_id", "full_date"), "date_id")
        .select("full_date", "daily_revenue")
        .orderBy("full_date")
    )


def best_sellers(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per product name; the price variants of a name count together."""
    per_product = fact.groupBy("product_id").agg(F.sum("quantity").alias("qty"), F.sum(units("total_amount")).alias("units"))
    return (
        per_product.join(products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(F.sum("qty").alias("total_qty_sold"), amount(F.sum("units")).alias("revenue"))
        .orderBy(F.desc("total_qty_sold"), "product_name")
    )


def top_products(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` best sellers with their rank; the window runs over these ``k`` rows only."""
    best = top_k(best_sellers(fact, products), k, F.desc("total_qty_sold"), F.asc("product_name"))
    position = Window.orderBy(F.desc("total_qty_sold"), F.asc("product_name"))
    return best.withColumn("position", F.row_number().over(position).cast("bigint"))


def sales_kpis(fact: DataFrame, products: DataFrame) -> DataFrame:
    """One row: revenue, orders, order value, units, best category, first and last day.

    The date key spells its date, so the days need no look-up.
    """
    per_product = fact.groupBy("product_id").agg(
        F.sum(units("total_amount")).alias("revenue"),
        F.count("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.min("date_id").alias("first_day"),
        F.max("date_id").alias("last_day"),
    )
    per_category = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            *[F.sum(c).alias(c) for c in ("revenue", "orders", "units")],
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
        )
    )
    totals = per_category.agg(
        amount(F.sum("revenue")).alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.sum("units").alias("total_units"),
        F.min_by("category", F.struct(-F.col("revenue"), "category")).alias("best_category"),
        F.to_date(F.min("first_day").cast("string"), "yyyyMMdd").alias("date_start"),
        F.to_date(F.max("last_day").cast("string"), "yyyyMMdd").alias("date_end"),
    )
    return totals.withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))
