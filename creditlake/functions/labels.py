"""Business labels as CASE chains over aggregates (first match wins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlake.schemas import (
    ENGAGEMENT_LEVEL_ELSE,
    ENGAGEMENT_LEVELS,
    INACTIVE_AFTER_DAYS,
    INVOICE_BALANCED,
    INVOICE_IN_CREDIT,
    INVOICE_IN_DEBIT,
    STATUS_AT_RISK,
    STATUS_HEALTHY,
    STATUS_LOW_BALANCE,
    STATUS_NOT_USING,
    USAGE_LEVEL_ELSE,
    USAGE_LEVELS,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _threshold_label(count: Column, levels, otherwise: str) -> Column:
    expr = None
    for minimum, label in levels:
        cond = count >= F.lit(minimum)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def usage_level(action_count: Column | str, levels=USAGE_LEVELS) -> Column:
    return _threshold_label(_c(action_count), levels, USAGE_LEVEL_ELSE)


def engagement_level(total_actions: Column | str, levels=ENGAGEMENT_LEVELS) -> Column:
    return _threshold_label(_c(total_actions), levels, ENGAGEMENT_LEVEL_ELSE)


def as_of_date(as_of) -> Column:
    """``as_of`` as a date Column; None means today (``CURRENT_DATE``)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def customer_status(
    last_activity: Column | str,
    consumed: Column | str,
    net: Column | str,
    as_of=None,
    inactive_days: int = INACTIVE_AFTER_DAYS,
) -> Column:
    cutoff = F.date_sub(as_of_date(as_of), inactive_days)
    return (
        F.when(_c(last_activity) < cutoff, F.lit(STATUS_AT_RISK))
        .when(_c(consumed) == 0, F.lit(STATUS_NOT_USING))
        .when(_c(net) < 0, F.lit(STATUS_LOW_BALANCE))
        .otherwise(F.lit(STATUS_HEALTHY))
    )


def invoice_status(net: Column | str) -> Column:
    return (
        F.when(_c(net) > 0, F.lit(INVOICE_IN_CREDIT))
        .when(_c(net) < 0, F.lit(INVOICE_IN_DEBIT))
        .otherwise(F.lit(INVOICE_BALANCED))
    )
