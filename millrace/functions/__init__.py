"""Scalar building blocks: native ``Column -> Column`` expressions, no UDFs."""

from millrace.functions.dates import (
    as_month,
    date_key,
    months_crossed,
    parse_mixed_date,
    tolerant_date,
)
from millrace.functions.labels import change_direction, run_status, status_class
from millrace.functions.numbers import cents_to_dollars, percent, percent_change, ratio, real_number, whole_number
from millrace.functions.text import default_if_blank, missing_markers_to_null, strip_all

__all__ = [
    "as_month", "cents_to_dollars", "change_direction", "date_key", "default_if_blank",
    "missing_markers_to_null", "months_crossed", "parse_mixed_date", "percent", "percent_change",
    "ratio", "real_number", "run_status", "status_class", "strip_all", "tolerant_date", "whole_number",
]
