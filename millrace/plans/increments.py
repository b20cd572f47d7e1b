"""Subscription marts kept up to date: monthly revenue and plan history, batch by batch.

Each batch costs what it brings. No increment reads an old subscription; what it needs of the past is in the marts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace import schemas
from millrace.functions import as_month
from millrace.operators.rows import keep_latest
from millrace.plans.subscriptions import plan_history
from millrace.session import own_scratch, write_once
from millrace.sources.warehouse import Change, Warehouse

# Monthly revenue --------------------------------------------------------------------------------------------------

_TOTALS = ["cents", "priced", "active"]
_PLAN = ["plan_key", "plan_type"]


def signed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """A change feed: versions of subscriptions that no longer hold with ``sign`` -1, and those that hold now with 1."""
    return before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))


def monthly_changes(changes: DataFrame) -> DataFrame:
    """What signed subscription rows change per plan and month: added in the first month, taken off after the last.

    A subscription without an end is never taken off, so advancing time changes nothing that is stored.
    """
    first, after = as_month(F.col("start_date")), F.add_months(as_month(F.col("end_date")), 1)
    cents = F.coalesce(F.floor(F.col("monthly_price_usd") * 100 + 0.5), F.lit(0))
    amounts = [cents, F.col("monthly_price_usd").isNotNull().cast("long"), F.lit(1).cast("long")]
    both = F.array(
        F.struct(first.alias("month"), F.col("sign").alias("_sign")), F.struct(after.alias("month"), (-F.col("sign")).alias("_sign"))
    )
    counted = changes.filter(first.isNotNull() & (after.isNull() | (first < after)))
    each = counted.select(
        F.xxhash64("plan_type").alias("plan_key"), "plan_type", *[a.alias(t) for a, t in zip(amounts, _TOTALS)], F.inline(both)
    )
    summed = each.filter("month IS NOT NULL").groupBy(*_PLAN, "month").agg(*[F.sum(F.col(t) * F.col("_sign")).alias(t) for t in _TOTALS])
    return summed.filter(" OR ".join(f"{t} <> 0" for t in _TOTALS)).select(*schemas.MRR_CHANGES.names)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_PLAN, "month").agg(*[F.sum(t).alias(t) for t in _TOTALS]).select(*schemas.MRR_CHANGES.names)


def _level_changes(changes: DataFrame, until: date) -> DataFrame:
    """The months up to ``until`` whose level changes: each stretch between two changes by their running sum."""
    in_time = Window.partitionBy(*_PLAN).orderBy("month")
    running = {t: F.sum(t).over(in_time.rowsBetween(Window.unboundedPreceding, 0)) for t in _TOTALS}
    last = as_month(F.lit(until))
    stretch = F.least(F.coalesce(F.add_months(F.lead("month").over(in_time), -1), last), last)
    levels = changes.withColumns(running | {"_until": stretch}).filter(F.col("month") <= F.col("_until"))
    levels = levels.filter(" OR ".join(f"{t} <> 0" for t in _TOTALS))
    return levels.withColumn("month", F.explode(F.expr("sequence(month, _until, interval 1 month)"))).drop("_until")


def _year() -> Column:
    return F.date_format("month", "yyyy")


def _month_of(as_of: date) -> int:
    return as_of.year * 100 + as_of.month


def increment_mrr(warehouse: Warehouse, changes: DataFrame, as_of: date, batch: tuple[str, int] | None = None) -> None:
    """Bring ``mrr_level`` up to a batch of signed subscription rows, and to the month of ``as_of``.

    ``mrr_change`` holds the changes per plan and month. A level is raised by the running sum of the batch's changes, in
    the months they reach and no others; months that begin since the last run continue from the newest level. Both tables
    are rewritten only where a plan and month of theirs changes, and are published by one commit.
    """
    spark = warehouse.spark
    with own_scratch(spark):
        known = warehouse.progress("mrr").get("as_of")
        if known is not None and _month_of(as_of) < known:
            raise ValueError(f"the revenue mart has reached {known} already")
        reached = date(known // 100, known % 100, 1) if known is not None else as_of
        delta = write_once(monthly_changes(changes), "mrr-delta")
        first = delta.agg(F.min("month")).first()[0]
        written: list[Change] = []
        keys = ["plan_key", "month"]

        def merged(table: str, more: DataFrame, since: date, part: Column) -> DataFrame:
            """The rows of ``more`` added to the stored ones of their plans and months."""
            stored = warehouse.read(table, schemas.MRR_CHANGES, since=part_name(since, table))
            rows = _summed(more.unionByName(stored.join(more.select(*keys), keys, "left_semi")))
            written.append(warehouse.upsert(table, rows, keys, ["plan_type"], part))
            return rows

        def part_name(month: date, table: str) -> str:
            return f"{month:%Y}" if table == "mrr_change" else f"{month:%Y-%m}"

        month = F.date_format("month", "yyyy-MM")
        levels = delta.limit(0)
        if first is not None:
            merged("mrr_change", delta, first, _year())
            levels = _level_changes(delta, reached)
        if _month_of(as_of) > _month_of(reached):
            # What has begun since: the newest level of each plan, as this batch leaves it, goes on with the changes after it.
            newest = as_month(F.lit(reached))
            stored = warehouse.read("mrr_level", schemas.MRR_LEVELS, since=f"{reached:%Y-%m}")
            base = _summed(stored.filter(F.col("month") == newest).unionByName(levels.filter(F.col("month") == newest)))
            pending = warehouse.read("mrr_change", schemas.MRR_CHANGES, since=f"{reached:%Y}").unionByName(delta)
            later = _summed(base.unionByName(pending.filter(F.col("month") > newest)))
            levels = levels.unionByName(_level_changes(later, as_of).filter(F.col("month") > newest))
        levels = write_once(levels, "mrr-levels")
        start = levels.agg(F.min("month")).first()[0]
        if start is not None:
            merged("mrr_level", levels, start, month)
        warehouse.commit(*written, batch=batch, progress={"mrr": {"as_of": _month_of(as_of)}})


def read_mrr(warehouse: Warehouse) -> DataFrame:
    """The mart, as ``subscriptions.fct_mrr`` computes it from all subscriptions; their ids must be unique."""
    levels = warehouse.read("mrr_level", schemas.MRR_LEVELS).filter("active > 0")
    usd = F.when(F.col("priced") > 0, F.round(F.col("cents") / 100, 2))
    return levels.select(F.col("month").alias("month_start"), "plan_type", F.col("active").alias("active_subscriptions"), usd.alias("mrr_usd"))


# Plan history -----------------------------------------------------------------------------------------------------

_CUSTOMER = "customer_id"


def _of(rows: DataFrame, customers: DataFrame, how: str = "left_semi") -> DataFrame:
    wanted = customers.select(F.col(_CUSTOMER).alias("_c"))
    return rows.join(wanted, F.col(_CUSTOMER).eqNullSafe(F.col("_c")), how)


def _days(rows: DataFrame) -> DataFrame:
    """One row per customer and day: of several subscriptions starting on a day the highest id counts."""
    return rows.filter("start_date IS NOT NULL").groupBy(_CUSTOMER, "start_date").agg(
        F.max_by("plan_type", "subscription_id").alias("plan_type"), F.max("subscription_id").alias("subscription_id")
    )


def _newest_open(warehouse: Warehouse) -> DataFrame:
    return keep_latest(warehouse.read("plan_open", schemas.PLAN_OPEN), [_CUSTOMER], ["n"])


def increment_history(warehouse: Warehouse, subscriptions: DataFrame, batch: tuple[str, int] | None = None) -> None:
    """Bring the plan history up to a batch of subscriptions, in whatever order of days they come.

    A customer whose new days are all newer than any known one needs their open version only: it is closed where the plan
    changes, and the last change opens the next one. A day that comes late may split a closed version, or bring to light a
    day that changed nothing before: the days of such customers, and of no others, are read and their history is written
    anew. Tables are only ever appended to; a row counts as long as no later batch has written its customer anew
    (``plan_reset``), and the open version is that of the last batch that has one.
    """
    spark = warehouse.spark
    with own_scratch(spark):
        n = warehouse.version() + 1
        days = write_once(_days(subscriptions.select(*schemas.PLAN_DAYS.names)), "plan-days")
        touched = days.groupBy(_CUSTOMER).agg(F.min("start_date").alias("_first"), F.max("start_date").alias("_last"))
        known = _of(_newest_open(warehouse), touched).withColumnRenamed(_CUSTOMER, "_known")
        met = touched.join(known, F.col(_CUSTOMER).eqNullSafe(F.col("_known")), "left")
        met = write_once(met.withColumn("_late", F.coalesce(F.col("_first") <= F.col("last_day"), F.lit(False))), "plan-customers")
        late = met.filter("_late")

        # The open version stands for a day on which its plan was taken.
        opened = met.filter("NOT _late AND n IS NOT NULL").select(_CUSTOMER, F.col("valid_from").alias("start_date"), "plan_type", F.lit(0).cast("long").alias("subscription_id"))
        current = _of(days, met.filter("NOT _late")).unionByName(opened)
        resets = late.select(_CUSTOMER, F.lit(n).alias("n"))
        if any_late := not late.isEmpty():
            stored = _of(warehouse.read("plan_day", schemas.PLAN_DAYS), late)
            current = current.unionByName(_days(_of(days, late).unionByName(stored)))
        versions = write_once(plan_history(current), "plan-versions")

        newest = met.select(F.col(_CUSTOMER).alias("_c"), F.greatest("_last", "last_day").alias("last_day"))
        last = versions.filter("is_current").join(newest, F.col(_CUSTOMER).eqNullSafe(F.col("_c")))
        last = last.select(_CUSTOMER, "plan_type", "valid_from", "last_day", F.lit(n).alias("n"))
        closed = versions.filter("NOT is_current").select(_CUSTOMER, "plan_type", "valid_from", "valid_to", F.lit(n).alias("n"))
        changes = [
            warehouse.append("plan_day", days.select(*schemas.PLAN_DAYS.names), F.date_format("start_date", "yyyy")),
            warehouse.append("plan_open", last.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PLAN_OPEN])),
            warehouse.append("plan_closed", closed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PLAN_CLOSED])),
        ]
        if any_late:
            changes.append(warehouse.append("plan_reset", resets.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PLAN_RESETS])))
        warehouse.commit(*changes, batch=batch)


def _closed(warehouse: Warehouse) -> DataFrame:
    """Closed versions that still count."""
    resets = warehouse.read("plan_reset", schemas.PLAN_RESETS).groupBy(F.col(_CUSTOMER).alias("_c")).agg(F.max("n").alias("_n"))
    rows = warehouse.read("plan_closed", schemas.PLAN_CLOSED).join(resets, F.col(_CUSTOMER).eqNullSafe(F.col("_c")), "left")
    return rows.filter(F.col("_n").isNull() | (F.col("n") >= F.col("_n"))).drop("_c", "_n")


def read_history(warehouse: Warehouse) -> DataFrame:
    """The history, as ``subscriptions.plan_history`` computes it from all subscriptions."""
    columns = [_CUSTOMER, "plan_type", "valid_from", "valid_to"]
    latest = _newest_open(warehouse).withColumn("valid_to", F.lit(None).cast("date"))
    both = _closed(warehouse).select(*columns).unionByName(latest.select(*columns))
    return both.withColumn("is_current", F.col("valid_to").isNull())


def compact_history(warehouse: Warehouse) -> None:
    """Rewrite the history without the rows that no longer count, after many batches."""
    columns = schemas.PLAN_RESETS.names
    empty = warehouse.read("plan_reset", schemas.PLAN_RESETS).limit(0).select(*columns)
    warehouse.commit(
        warehouse.replace("plan_open", _newest_open(warehouse)),
        warehouse.replace("plan_closed", _closed(warehouse)),
        warehouse.replace("plan_reset", empty),
    )
