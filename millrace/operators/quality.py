"""Data-quality gates and declarative tests.

A check names the rows that break a rule. Counting violations with ``coalesce(bad, true)`` keeps three-valued logic
honest: an unknown outcome is a violation, and a frame without rows has none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """Raised when a gate fails; the message names every failed check."""


@dataclass(frozen=True)
class Check:
    """``violated`` is true (or unknown) on rows that break the rule called ``name``."""

    name: str
    violated: Column


def not_positive(col: str) -> Column:
    """True for values that are not above zero, NaN included (Spark sorts NaN above every number)."""
    return F.isnan(F.col(col).cast("double")) | (F.col(col) <= 0)


def gate_report(df: DataFrame, checks: Sequence[Check], unique_key: str | None = None) -> DataFrame:
    """Violations per check as rows ``(check_name, violations, passed)``, from one pass over ``df``.

    With ``unique_key`` the counts are first taken per key, which shows repeated keys in the same pass; the map-side
    combine keeps a hot key small.
    """
    names = [c.name for c in checks]
    counts = [F.count_if(F.coalesce(c.violated, F.lit(True))).alias(f"_c{i}") for i, c in enumerate(checks)]
    if unique_key is not None:
        per_key = df.groupBy(unique_key).agg(F.count(F.lit(1)).alias("_n"), *counts)
        names = [*names, f"{unique_key} is unique"]
        counts = [F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(checks))]
        counts.append(F.sum(F.col("_n") - 1).alias(f"_c{len(checks)}"))
        totals = per_key.agg(*counts)
    else:
        totals = df.agg(*counts)
    return _as_lines(totals, names)


def _as_lines(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """The one row of counts ``_c0, _c1, ...`` as a line per check."""
    lines = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(F.col(f"_c{i}"), F.lit(0)).alias("violations"))
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*lines))).withColumn("passed", F.col("violations") == 0)


def enforce(report: DataFrame) -> None:
    """Raise if any check of a gate report failed. Only the report, one row per check, reaches the driver."""
    failed = [r.check_name for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise DataQualityError(f"quality gate failed: {', '.join(failed)}")


def error_rate(df: DataFrame, checks: Sequence[Check], threshold: float) -> DataFrame:
    """Share of rows that break at least one rule, and whether it stays within ``threshold``."""
    invalid = F.lit(False)
    for check in checks:
        invalid = invalid | F.coalesce(check.violated, F.lit(True))
    rate = F.coalesce(F.try_divide(F.col("invalid_rows").cast("double"), F.col("total_rows")), F.lit(0.0))
    return (
        df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(invalid).alias("invalid_rows"))
        .withColumn("error_rate", rate)
        .withColumn("passed", F.col("error_rate") <= threshold)
    )


def enforce_error_rate(df: DataFrame, checks: Sequence[Check], threshold: float = 0.05) -> None:
    outcome = error_rate(df, checks, threshold).first()
    if not outcome.passed:
        raise DataQualityError(f"{outcome.invalid_rows} of {outcome.total_rows} rows are invalid")


# Declarative tests return the failing rows; an empty result passes.


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once, nulls aside."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_col).alias(col)).filter(F.col(col).isNotNull())
    return child.filter(F.col(col).isNotNull()).join(parents, col, "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return df.filter(~F.col(col).isin(list(values)))


def model_report(
    df: DataFrame,
    model: str,
    unique_col: str | None = None,
    required: Sequence[str] = (),
    accepted: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The first, second and last of these tests for a whole model in one pass: number of failing results per test."""
    accepted = accepted or {}
    names = [f"not_null {model}.{c}" for c in required] + [f"accepted_values {model}.{c}" for c in accepted]
    failing = [F.col(c).isNull() for c in required] + [~F.col(c).isin(list(v)) for c, v in accepted.items()]
    counts = [F.count_if(f).alias(f"_c{i}") for i, f in enumerate(failing)]
    if unique_col is not None:
        names.append(f"unique {model}.{unique_col}")
        per_value = df.groupBy(unique_col).agg(F.count(F.lit(1)).alias("_n"), *counts)
        repeated = F.count_if((F.col("_n") > 1) & F.col(unique_col).isNotNull()).alias(f"_c{len(counts)}")
        return _as_lines(per_value.agg(*[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counts))], repeated), names)
    return _as_lines(df.agg(*counts), names)


def run_tests(tests: dict[str, DataFrame]) -> DataFrame:
    """Number of failing rows per test, all tests in one job."""
    report = None
    for name, failing in tests.items():
        line = failing.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        report = line if report is None else report.unionAll(line)
    return report.withColumn("passed", F.col("violations") == 0)
