"""Sales: order lines with their order, customer and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from millrace import schemas
from millrace.functions import date_key, default_if_blank, parse_mixed_date, whole_number
from millrace.operators.quality import DataQualityError
from millrace.operators.rows import duplicate_count
from millrace.plans import sales
from millrace.session import scratch_path, write_once
from millrace.sources.files import read_sales_csv, read_seed_csv
from millrace.sources.warehouse import Warehouse
from workload import table

# Stands in for the ingest order of a file.
SEQ = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
# Order lines in a landed file of the block reader, of some 130 bytes each: several blocks a file.
LINES_PER_FILE = 2_000_000


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with all they refer to. Customers meet the orders, of which there are fewer than lines, so that no line
    is shuffled by its customer; orders come last, so that the lines of an order leave in one task."""
    customer = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _every(col: str, n: int):
    return F.col(col) % n == 0


def _spoilt_date():
    day = F.col("o_orderdate")
    text = F.when(_every("o_orderkey", 3), F.date_format(day, "dd/MM/yyyy")).when(
        _every("o_orderkey", 5), F.date_format(day, "yyyy-M-d")
    ).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return F.when(_every("o_orderkey", 7), F.concat(F.lit(" \t"), text, F.lit(" "))).otherwise(text)


def _spoilt_quantity():
    text = F.col("l_quantity").cast("int").cast("string")
    return F.when(_every("l_partkey", 17), "").when(~_every("l_partkey", 13), F.concat(F.lit(" "), text))


def _spoilt_name():
    text = F.when(_every("c_custkey", 4), F.concat(F.lit("\u3000 "), F.col("c_name"), F.lit("\t"))).otherwise(F.col("c_name"))
    return F.when(_every("c_custkey", 11), F.lit(" ")).when(~_every("c_custkey", 13), text)


def _email():
    return F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example"))


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty rows: mixed date formats, padded text, blank names and quantities, and the table's own repeated ids."""
    return _lines(spark, sf).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("order_id"),
        _spoilt_date().alias("order_date"),
        _spoilt_name().alias("customer_name"),
        F.concat(F.lit(" "), _email(), F.lit(" ")).alias("customer_email"),
        F.when(_every("l_partkey", 5), F.concat(F.lit("\t"), F.col("p_name"))).otherwise(F.col("p_name")).alias("product_name"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("category"),
        _spoilt_quantity().alias("quantity"),
        F.col("p_retailprice").cast("string").alias("unit_price"),
        F.col("n_name").alias("city"),
        *SEQ,
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return sales.clean_sales(raw_sales(spark, sf), SEQ)


def _fact(spark: SparkSession, sf: str, with_orders: bool = True) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    columns = [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    ]
    if not with_orders:
        return lines.select(*columns)
    lines = lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(*columns, date_key(F.col("o_orderdate")).alias("date_id"), F.col("o_custkey").alias("customer_id"))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("n_name").alias("city")
        )
    )


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    return sales.dim_date(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("order_date")))


def clean_text(spark, sf):
    return (
        raw_sales(spark, sf)
        .transform(sales.clean_text)
        .select("customer_name", "customer_email", "product_name", "category", "city")
    )


def default_name(spark, sf):
    text = sales.clean_text(raw_sales(spark, sf))
    name = default_if_blank(F.col("customer_name"), "Unknown Customer").alias("customer_name")
    return text.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", name)


def default_quantity(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", whole_number(_spoilt_quantity(), "1").alias("quantity"))


def mixed_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", parse_mixed_date(_spoilt_date()).alias("order_date"))


def dedupe_first(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "order_id", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    )
    return sales.first_orders(lines, SEQ).select("order_id", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def dedupe_count(spark, sf):
    return duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def star(spark, sf):
    """The whole path: dirty rows, cleaning, dimensions with dense ids, fact."""
    clean = write_once(cleaned(spark, sf), "clean-sales", compression="zstd")
    return sales.fact_sales(clean, sales.dim_customer(clean, SEQ, dense=True), sales.dim_product(clean, SEQ, dense=True))


def stored_star(spark, sf):
    """The load as a job runs it, gates and publishing included, then a report over the published tables."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    sales.load_star(warehouse, raw_sales(spark, sf), SEQ)
    fact = warehouse.read("fact_sales", schemas.FACT_SALES)
    return sales.revenue_by_category(fact, warehouse.read("dim_product", schemas.DIM_PRODUCT))


def hashed_star(spark, sf):
    """Order lines read back through the hashed keys of a stored star."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    sales.load_star(warehouse, raw_sales(spark, sf), SEQ)
    fact = warehouse.read("fact_sales", schemas.FACT_SALES)
    customers = warehouse.read("dim_customer", schemas.DIM_CUSTOMER)
    products = warehouse.read("dim_product", schemas.DIM_PRODUCT).drop("unit_price")
    joined = fact.join(customers, "customer_id").join(products, "product_id").join(warehouse.read("dim_date", schemas.DIM_DATE), "date_id")
    return joined.select("order_id", "full_date", "customer_email", "customer_name", "product_name", "category", "unit_price", "quantity")


def failed_gate(spark, sf):
    """A load with one bad line after a good one of half the lines: what was published stays as it was."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    raw = write_once(raw_sales(spark, sf), "raw-sales", compression="zstd")  # landed once, loaded twice
    sales.load_star(warehouse, raw.filter(F.col("l_orderkey") % 2 == 0), SEQ)
    broken = raw.withColumn("unit_price", F.when(F.col("l_orderkey") % 1000 != 7, F.col("unit_price")).otherwise("none"))
    try:
        sales.load_star(warehouse, broken, SEQ)
    except DataQualityError:
        fact = warehouse.read("fact_sales", schemas.FACT_SALES)
        return fact.groupBy("date_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("units"))
    raise RuntimeError("the gate let a price that is no number pass")


def _landed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The order lines with shuffled columns, doubled quotes and line breaks in fields."""
    quoted = F.concat(F.lit('Say "hi", '), F.col("c_name"), F.lit("\nto me"))
    return _lines(spark, sf).select(
        F.col("n_name").alias("city"),
        F.col("p_retailprice").cast("string").alias("unit_price"),
        F.when(~_every("l_partkey", 13), F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.lit("not asked for").alias("more"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_name"), F.lit(' 5" x,')).alias("product_name"),
        _email().alias("customer_email"),
        F.when(_every("l_partkey", 3), quoted).otherwise(F.col("c_name")).alias("customer_name"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_date"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("order_id"),
    )


def scan_csv(spark, sf):
    """Written as CSV and read back by name."""
    path = scratch_path(spark, "csv")
    _landed_csv(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return read_sales_csv(spark, path).drop("seq")


def scan_csv_blocks(spark, sf):
    """Written as two files or more of bounded size, each of which is read by as many tasks as it has blocks."""
    path = scratch_path(spark, "csv")
    files = max(2, -(-table(spark, sf, "lineitem").count() // LINES_PER_FILE))
    _landed_csv(spark, sf).repartition(files).write.option("header", True).option("escape", '"').csv(path)
    return read_sales_csv(spark, path, parallel=True).drop("seq")


def scan_seed(spark, sf):
    """Customers written as CSV with other columns beside the typed ones, and read back."""
    path = scratch_path(spark, "csv")
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal", "c_name", F.lit("x,\"y\"").alias("more"), "c_custkey")
    customers.write.option("header", True).option("escape", '"').csv(path)
    return read_seed_csv(spark, path, StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("c_acctbal", DoubleType())]))


QUERIES = {
    "sales_clean_text": clean_text,
    "sales_default_name": default_name,
    "sales_default_quantity": default_quantity,
    "sales_parse_mixed_date": mixed_date,
    "sales_dedupe_first": dedupe_first,
    "sales_dedupe_count": dedupe_count,
    "sales_clean_orders": lambda s, d: cleaned(s, d).select(*sales.CLEAN_COLUMNS),
    "sales_dim_customer": lambda s, d: sales.dim_customer(cleaned(s, d), SEQ, dense=True),
    "sales_dim_product": lambda s, d: sales.dim_product(cleaned(s, d), SEQ, dense=True),
    "sales_dim_date": _dates,
    "sales_fact": star,
    "sales_star_load": lambda s, d: stored_star(s, d),
    "sales_star_hashed": hashed_star,
    "sales_failed_gate": failed_gate,
    "scan_sales_csv": scan_csv,
    "scan_sales_csv_blocks": scan_csv_blocks,
    "scan_seed_csv": scan_seed,
    "sales_revenue_by_category": lambda s, d: sales.revenue_by_category(_fact(s, d, False), _products(s, d)),
    "sales_top_customers": lambda s, d: sales.top_customers(_fact(s, d), _customers(s, d), 10),
    "sales_daily_revenue": lambda s, d: sales.daily_revenue(_fact(s, d), _dates(s, d)),
    "sales_best_sellers": lambda s, d: sales.best_sellers(_fact(s, d, False), _products(s, d)),
    "sales_top5_products": lambda s, d: sales.top_products(_fact(s, d, False), _products(s, d)),
    "sales_kpis": lambda s, d: sales.sales_kpis(_fact(s, d), _products(s, d)),
}

_SEQ_SQL = ", ".join(SEQ)
_CLEAN = f"""
WITH lines AS (
  SELECT *, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS order_id
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
), clean AS (
  SELECT order_id, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'Unknown Customer' ELSE c_name END AS customer_name,
    lower(replace(c_name, '#', '.')) || '@mail.example' AS customer_email,
    p_name AS product_name, p_type AS category,
    CASE WHEN l_partkey % 17 = 0 OR l_partkey % 13 = 0 THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
    p_retailprice AS unit_price, n_name AS city, {_SEQ_SQL}
  FROM lines
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_SEQ_SQL}) = 1
), dim_customer AS (
  SELECT row_number() OVER (ORDER BY {_SEQ_SQL}) AS customer_id, customer_name, customer_email, city
  FROM (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY customer_email ORDER BY {_SEQ_SQL}) = 1)
), dim_product AS (
  SELECT row_number() OVER (ORDER BY {_SEQ_SQL}) AS product_id, product_name, category, unit_price
  FROM (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY product_name, unit_price ORDER BY {_SEQ_SQL}) = 1)
)
"""
_MONEY = "CAST(sum(CAST({} AS DECIMAL(18, 2))) AS DOUBLE)"
_REVENUE = _MONEY.format("l_extendedprice")

ORACLE = {
    "sales_clean_text": """
SELECT CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN '' ELSE c_name END AS customer_name,
  lower(replace(c_name, '#', '.')) || '@mail.example' AS customer_email,
  p_name AS product_name, p_type AS category, n_name AS city
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "sales_default_name": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'Unknown Customer' ELSE c_name END AS customer_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "sales_default_quantity": """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 17 = 0 OR l_partkey % 13 = 0 THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS quantity
FROM lineitem""",
    "sales_parse_mixed_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "sales_dedupe_first": f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_id, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_SEQ_SQL}) = 1""",
    "sales_dedupe_count": """
SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS dropped_rows FROM lineitem""",
    "sales_clean_orders": _CLEAN + """
SELECT order_id, order_date, customer_name, customer_email, product_name, category, quantity, unit_price, city,
  quantity * unit_price AS total_amount FROM clean""",
    "sales_dim_customer": _CLEAN + "SELECT * FROM dim_customer",
    "sales_dim_product": _CLEAN + "SELECT * FROM dim_product",
    "sales_dim_date": """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, CAST(o_orderdate AS DATE) AS full_date,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, dayname(o_orderdate) AS day_of_week
FROM orders""",
    "sales_fact": _CLEAN + """
SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_id, customer_id, product_id, quantity,
  c.unit_price, quantity * c.unit_price AS total_amount
FROM clean c JOIN dim_customer USING (customer_email)
JOIN dim_product p ON c.product_name = p.product_name AND c.unit_price = p.unit_price""",
    "sales_star_load": _CLEAN + """
SELECT p.category, CAST(sum(quantity * CAST(unit_price AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
  count(*) AS total_orders
FROM clean JOIN dim_product p USING (product_name, unit_price) GROUP BY 1""",
    "sales_star_hashed": _CLEAN + """
SELECT order_id, order_date AS full_date, customer_email, d.customer_name, p.product_name, p.category, c.unit_price, quantity
FROM clean c JOIN dim_customer d USING (customer_email)
JOIN dim_product p ON c.product_name = p.product_name AND c.unit_price = p.unit_price""",
    "sales_failed_gate": _CLEAN + """
SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_id, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units
FROM clean WHERE l_orderkey % 2 = 0 GROUP BY 1""",
    "scan_sales_csv": """
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_id, strftime(o_orderdate, '%d/%m/%Y') AS order_date,
  CASE WHEN l_partkey % 3 = 0 THEN 'Say "hi", ' || c_name || chr(10) || 'to me' ELSE c_name END AS customer_name,
  lower(replace(c_name, '#', '.')) || '@mail.example' AS customer_email, p_name || ' 5" x,' AS product_name, p_type AS category,
  CASE WHEN l_partkey % 13 <> 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
  CAST(p_retailprice AS VARCHAR) AS unit_price, n_name AS city
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "scan_seed_csv": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "sales_revenue_by_category": f"""
SELECT p_type AS category, {_REVENUE} AS total_revenue, count(*) AS total_orders
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY total_revenue DESC""",
    "sales_top_customers": f"""
SELECT o_custkey AS customer_id, c_name AS customer_name, n_name AS city, {_REVENUE} AS total_spent,
  count(*) AS total_orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3 ORDER BY total_spent DESC, 1 LIMIT 10""",
    "sales_daily_revenue": f"""
SELECT CAST(o_orderdate AS DATE) AS full_date, {_REVENUE} AS daily_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 1""",
    "sales_best_sellers": f"""
SELECT p_name AS product_name, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty_sold, {_REVENUE} AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1""",
    "sales_top5_products": f"""
SELECT *, row_number() OVER (ORDER BY total_qty_sold DESC, product_name) AS position FROM (
  SELECT p_name AS product_name, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty_sold, {_REVENUE} AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)""",
    "sales_kpis": f"""
WITH per_category AS (
  SELECT p_type, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT {_REVENUE} AS total_revenue, count(*) AS total_orders,
  CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_units,
  (SELECT p_type FROM per_category ORDER BY revenue DESC, p_type LIMIT 1) AS best_category,
  CAST(min(o_orderdate) AS DATE) AS date_start, CAST(max(o_orderdate) AS DATE) AS date_end,
  {_REVENUE} / count(*) AS avg_order_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
ORACLE["scan_sales_csv_blocks"] = ORACLE["scan_sales_csv"]
