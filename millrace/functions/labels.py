"""Classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_class(code: Column) -> Column:
    """200-399 is a success, 400-499 a client error, every other code a server error."""
    return (
        F.when(code.between(200, 399), "success")
        .when(code.between(400, 499), "client_error")
        .otherwise("server_error")
    )


def change_direction(change: Column) -> Column:
    return F.when(change > 0, "up").when(change < 0, "down").otherwise("flat")


def run_status(succeeded: Column, failed: Column) -> Column:
    return F.when(failed == 0, "success").when(succeeded > 0, "partial_failure").otherwise("failed")
