"""Planned against actual visits per route and month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import month_start, ym, ym_back
from martloom.rules import DEFAULT_RULES, Rules

_CUSTOMER_MONTH = ["BranchCode", "RouteCode", "Salesman", "YM", "Customer"]


def _lagged(visits: DataFrame, route: DataFrame, day: str, rules: Rules) -> tuple[DataFrame, Column]:
    """Visit rows with the sales type of their route, and the month they count for."""
    lag = F.when(F.col("SalesType1") == rules.next_day_sales_type, 1).otherwise(0)
    return visits.join(route.select("Route", "SalesType1"), "Route", "left"), ym(F.date_add(F.to_date(day), lag))


def _monthly(
    visits: DataFrame, route: DataFrame, day: str, name: str, as_of: date | None, months: int | None, rules: Rules
) -> DataFrame:
    """Visit rows with the month they count for; next-day routes count one day later."""
    if months is not None:
        # Implied by the month filter below, and simple enough to reach the scan.
        visits = visits.filter(F.col(day) >= F.date_sub(month_start(as_of, months), 1))
    typed, month = _lagged(visits, route, day, rules)
    counted = typed.select(
        F.col("Branch").alias("BranchCode"), F.col("Route").alias("RouteCode"), "Salesman", month.alias("YM"), "Customer",
        F.lit(1 if name == "plan" else 0).alias("_plan"), F.lit(0 if name == "plan" else 1).alias("_actual"),
    )
    return counted if months is None else counted.filter(F.col("YM") >= ym_back(as_of, months))


def _both(
    planned: DataFrame, actual: DataFrame, route: DataFrame, as_of: date | None, months: int | None, rules: Rules
) -> DataFrame:
    return _monthly(planned, route, "AssignedDate", "plan", as_of, months, rules).unionByName(
        _monthly(actual, route, "VisitDate", "actual", as_of, months, rules)
    )


def _counting() -> list[Column]:
    """Visits planned and made, none under a key that holds a NULL."""
    whole = F.lit(True)
    for key in _CUSTOMER_MONTH:
        whole = whole & F.col(key).isNotNull()
    return [F.when(whole, F.col(c)).otherwise(0) for c in ("_plan", "_actual")]


def visit_totals(
    planned: DataFrame, actual: DataFrame, route: DataFrame, *,
    as_of: date | None = None, months: int | None = 2, rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """The visits of ``visit_calls`` per branch, route and month, without its counts of customers and its salesmen.

    Nothing is told per customer, so visits are added up map-side and few rows move.
    """
    return _added_up(_both(planned, actual, route, as_of, months, rules))


def marked_totals(visits: DataFrame, route: DataFrame, *, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``visit_totals`` of all months, of planned and actual visits in one frame: their day is `_day`, `_plan` and `_actual` mark them."""
    typed, month = _lagged(visits, route, "_day", rules)
    return _added_up(typed.select(
        F.col("Branch").alias("BranchCode"), F.col("Route").alias("RouteCode"), "Salesman", month.alias("YM"), "Customer",
        "_plan", "_actual",
    ))


def _added_up(visits: DataFrame) -> DataFrame:
    plan, made = _counting()
    return visits.groupBy(
        "BranchCode", "RouteCode", F.concat_ws("", "YM", F.lit("01")).alias("DateKey")
    ).agg(F.sum(plan).alias("NoOfPlanVisit"), F.sum(made).alias("NoOfActualVisit"))


def visit_calls(
    planned: DataFrame, actual: DataFrame, route: DataFrame, *,
    as_of: date | None = None, months: int | None = 2, rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Customers and visits planned, made, and both, per branch, route, salesman and month.

    Plan and actual go through one union and two aggregations in place of a key spine
    joined back to each side. A key holding a NULL stays in the result but counts nothing,
    as NULL keys meet nothing in a join.
    """
    per_customer = _both(planned, actual, route, as_of, months, rules).groupBy(*_CUSTOMER_MONTH).agg(
        F.sum("_plan").alias("_plan"), F.sum("_actual").alias("_actual")
    )
    plan, made = _counting()
    return per_customer.groupBy(
        "BranchCode", "RouteCode", "Salesman", F.concat_ws("", "YM", F.lit("01")).alias("DateKey")
    ).agg(
        F.sum((plan > 0).cast("long")).alias("CustomerPlanVisit"),
        F.sum((made > 0).cast("long")).alias("CustomerActualVisit"),
        F.sum(((plan > 0) & (made > 0)).cast("long")).alias("CustomerVisitOnPlan"),
        F.sum(plan).alias("NoOfPlanVisit"),
        F.sum(made).alias("NoOfActualVisit"),
    )
