"""Quality gates and declarative tests, over tables spoilt by fixed rules so that there is something to find."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans import sales
from workload import table


def _every(col: str, n: int):
    return F.col(col) % n == 0


def sales_rows(s, d):
    """Repeated ids, zero quantities, prices that are null, NaN or negative, empty addresses and missing dates."""
    price = (
        F.when(_every("l_partkey", 101), F.lit(float("nan")))
        .when(_every("l_partkey", 89), -F.col("l_extendedprice"))
        .when(~_every("l_partkey", 103), F.col("l_extendedprice"))
    )
    return table(s, d, "lineitem").select(
        F.when(~_every("l_orderkey", 997), F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        (F.col("l_quantity").cast("int") - 1).alias("quantity"),
        price.alias("unit_price"),
        F.when(_every("l_suppkey", 17), "").otherwise("x@mail.example").alias("customer_email"),
        F.when(~_every("l_orderkey", 107), F.to_date("l_shipdate")).alias("order_date"),
    )


def _orders(s, d):
    return table(s, d, "orders").select(
        "o_orderkey",
        F.when(~_every("o_orderkey", 50), F.col("o_custkey") + F.when(_every("o_orderkey", 40), 10**9).otherwise(0)).alias(
            "customer_id"
        ),
        F.when(~_every("o_orderkey", 60), F.col("o_orderstatus")).alias("status"),
    )


QUERIES = {
    "dq_gate_report": lambda s, d: sales.sales_gate(sales_rows(s, d)),
    "dq_error_rate": lambda s, d: quality.error_rate(sales_rows(s, d), sales.gate_checks(), 0.05),
    "dq_not_null": lambda s, d: quality.not_null(_orders(s, d), "customer_id"),
    "dq_unique": lambda s, d: quality.unique(sales_rows(s, d), "order_id"),
    "dq_relationships": lambda s, d: quality.relationships(
        _orders(s, d), "customer_id", table(s, d, "customer"), "c_custkey"
    ).select("o_orderkey", "customer_id", "status"),
    "dq_accepted_values": lambda s, d: quality.accepted_values(_orders(s, d), "status", ["F", "O"]),
}

_SALES = """
WITH sales AS (
  SELECT CASE WHEN l_orderkey % 997 <> 0 THEN l_orderkey * 10 + l_linenumber END AS order_id,
    CAST(l_quantity AS INTEGER) - 1 AS quantity,
    l_partkey % 101 = 0 OR l_partkey % 89 = 0 OR l_partkey % 103 = 0 AS bad_price,
    l_suppkey % 17 = 0 AS bad_email, l_orderkey % 107 = 0 AS bad_date
  FROM lineitem
)
"""
_GATE = [
    ("order_id is not null", "order_id IS NULL"),
    ("quantity > 0", "quantity <= 0"),
    ("unit_price > 0", "bad_price"),
    ("customer_email is not empty", "bad_email"),
    ("order_date is not null", "bad_date"),
]
_ORDERS = """
WITH spoilt AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey + CASE WHEN o_orderkey % 40 = 0 THEN 1000000000 ELSE 0 END END
      AS customer_id,
    CASE WHEN o_orderkey % 60 <> 0 THEN o_orderstatus END AS status
  FROM orders
)
"""

ORACLE = {
    "dq_gate_report": _SALES
    + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations, count(*) = 0 AS passed FROM sales WHERE {bad}"
        for name, bad in _GATE
    )
    + """ UNION ALL SELECT 'order_id is unique', CAST(sum(n - 1) AS BIGINT), sum(n - 1) = 0
FROM (SELECT count(*) AS n FROM sales GROUP BY order_id)""",
    "dq_error_rate": _SALES + f"""
SELECT *, invalid_rows / total_rows AS error_rate, invalid_rows / total_rows <= 0.05 AS passed FROM (
  SELECT count(*) AS total_rows, count(*) FILTER ({' OR '.join(bad for _, bad in _GATE)}) AS invalid_rows FROM sales)""",
    "dq_not_null": _ORDERS + "SELECT * FROM spoilt WHERE customer_id IS NULL",
    "dq_unique": _SALES + """
SELECT order_id, count(*) AS n_records FROM sales WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_relationships": _ORDERS + """
SELECT * FROM spoilt WHERE customer_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)""",
    "dq_accepted_values": _ORDERS + "SELECT * FROM spoilt WHERE status NOT IN ('F', 'O')",
}
