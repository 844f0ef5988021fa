"""The nightly loads in dependency order, each table with its replace scope.

``stage`` and ``sheet`` are functions from a table name to its staged or landed frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import ym
from martloom.plans import assets, dims, facts, outlets, scorecard, visits, volume
from martloom.rules import DEFAULT_RULES, Rules
from martloom.sinks.changes import changed, remember, states
from martloom.sinks.store import NO_VALUE, Mart, window_month, with_load_day, with_month
from martloom.sources.landing import has_rows

Tables = Callable[[str], DataFrame]


COPIED = [
    "DimChannel", "DimCustGrp1", "DimCustGrpSap", "DimPromotion", "DimReason", "DimMaterial", "DimMaterialOld",
    "DimCustomerOld",
]
# fact -> days of load stamps replaced every night
FACT_DAYS = {"FactAllDataInvoice": 5, "FactVisitList": 1, "FactActualVisit": 1, "FactDataAsset": 1}
# fact -> partition columns: the month its readers ask for, then the load day its replace is scoped by
LAYOUT = {
    "FactAllDataInvoice": ("YM", "etl_date"), "FactDataAsset": ("YM", "etl_date"),
    "FactVisitList": ("visit_ym", "etl_date"), "FactActualVisit": ("visit_ym", "etl_date"),
}
VISIT_DAY = {"FactVisitList": "AssignedDate", "FactActualVisit": "VisitDate"}
LAST_DAYS = "InvoiceLastDay"  # YM, LastDay: newest billing day of every month of the invoice fact
BRANCH_TARGETS = ["FactAOP", "FactAOPDM", "FactAOPNDDM", "FactAOPRoute", "FactAOPNDRoute"]
MANAGER_TARGETS = ["FactAOPTDM", "FactAOPNDTDM"]


def load_dimensions(
    mart: Mart, stage: Tables, sheet: Tables, boundary: DataFrame, *, cell: float = 0.25, salts: int = 1,
) -> dict[str, int]:
    """Full refresh of the dimensions, and of route staff for the months of the route sheet.

    ``cell`` and ``salts`` say how finely points are dealt for the search of their region.
    """
    built = {name: dims.copy_table(stage(name), name) for name in COPIED}
    built |= {
        "DimCustomer": dims.customers(stage("DimCustomerOld"), stage("DimCustomer"), boundary, cell=cell, salts=salts),
        "DimLocation": dims.locations(stage("DimLocation"), sheet("DimLocation"), boundary, cell=cell, salts=salts),
        "DimRoute": dims.routes(sheet("DimRoute"), stage("DimRoute")),
        "DimSalesman": dims.salesmen(sheet("DimSalesman"), stage("DimSalesman")),
        "DimBillingDate": dims.billing_calendar(stage("DimBillingDate"), sheet("DimBillingDate")),
    }
    written = {name: mart.overwrite(name, dims.stamped(df)) for name, df in built.items()}
    people = dims.route_salesmen(sheet("DimRoute"), stage("DimRoute"))
    written["FactRouteSalesman"] = mart.replace_partitions("FactRouteSalesman", dims.stamped(people), "YM")
    return written


def load_facts(
    mart: Mart, stage: Tables, as_of: date, *, full: bool = False, visits_since: str = "202110"
) -> dict[str, int]:
    """Replace the last load days of every fact; ``full`` loads all history once.

    Facts are partitioned by month and load day, so both the month windows of the aggregates and the
    day window of the load touch only their own directories.
    """
    def days(table: str) -> int | None:
        return None if full else FACT_DAYS[table]

    plan = facts.customer_plan(stage("FactCustPerMonPlan"))
    built = {
        "FactAllDataInvoice": facts.invoices(
            stage("FactAllDataInvoice"), mart.read("DimMaterial"), as_of=as_of, days=days("FactAllDataInvoice")),
        "FactVisitList": facts.visit_list(stage("FactVisitList"), as_of=as_of, days=days("FactVisitList")),
        "FactActualVisit": (
            facts.actual_visits_full(stage("FactActualVisit"), since=visits_since) if full
            else facts.actual_visits(stage("FactActualVisit"), as_of=as_of)),
        "FactDataAsset": facts.assets(stage("FactDataAsset"), plan, as_of=as_of, days=days("FactDataAsset")),
    }
    written = {"FactCustPerMonPlan": mart.overwrite("FactCustPerMonPlan", dims.stamped(plan))}
    for table, df in built.items():
        rows = with_load_day(dims.stamped(df))
        if table in VISIT_DAY:
            rows = rows.withColumn("visit_ym", ym(F.to_date(VISIT_DAY[table])))
        if full:
            written[table] = mart.overwrite(table, rows, LAYOUT[table])
        else:
            since = (as_of - timedelta(days=FACT_DAYS[table])).isoformat()
            before = _months_loaded(mart, table, since) if table == "FactAllDataInvoice" else set()
            written[table] = mart.replace_window(table, rows, LAYOUT[table], since)
            if table == "FactAllDataInvoice":
                _refresh_last_days(mart, before | _months_loaded(mart, table, since))
    if full:
        _refresh_last_days(mart, None)
    return written


def _months_loaded(mart: Mart, table: str, since: str) -> set[str]:
    """Months that hold load days of a window, from the directory names."""
    return {month for month, day in mart.partitions(table, LAYOUT[table]) if day >= since and day != NO_VALUE}


def _refresh_last_days(mart: Mart, months: set[str] | None) -> None:
    """Recompute the last billing day of the months a load touched (None: all); other months are not read."""
    invoice = mart.read("FactAllDataInvoice")
    if months is not None:
        invoice = invoice.filter(F.col("YM").isin(sorted(months)))
    days = invoice.filter(F.col("YM").isNotNull()).groupBy("YM").agg(F.max("DateKey").alias("LastDay"))
    if months is None or not mart.exists(LAST_DAYS):
        mart.overwrite(LAST_DAYS, days)
    else:
        touched = mart.spark.createDataFrame([(m,) for m in sorted(months)], "YM string")
        kept = mart.read(LAST_DAYS).join(touched, "YM", "left_anti")
        mart.overwrite(LAST_DAYS, kept.unionByName(days))


def load_targets(mart: Mart, sheet: Tables) -> dict[str, int]:
    """Targets: months in a landing replace the stored months. Empty landings change nothing.

    The landing itself is stored and overwritten first; branch and route targets keep its load time.
    """
    written = {}
    for table in BRANCH_TARGETS + MANAGER_TARGETS:
        landing = sheet(table)
        if has_rows(landing):
            landed = f"{table}Excel"
            written[landed] = mart.overwrite(landed, dims.stamped(landing))
            landing = mart.read(landed)
            rows = (dims.stamped(facts.manager_targets(landing, table)) if table in MANAGER_TARGETS
                    else facts.targets(landing, table, keep_stamp=True))
            written[table] = mart.replace_partitions(table, rows, "YM")
    return written


@dataclass(frozen=True)
class Step:
    table: str
    build: Callable[[Tables, date, Rules], DataFrame]
    months: int | None  # trailing window replaced; None replaces the whole table


def _sales(job):
    def build(t: Tables, as_of: date, rules: Rules) -> DataFrame:
        return job(
            t("FactAllDataInvoice"), t("DimReason"), t("DimCustomer"), t("DimMaterial"), as_of=as_of, rules=rules
        )
    return build


def _since(t: Tables, table: str, month: str, column: str) -> DataFrame:
    """A table from a month on; the bound is a constant and prunes."""
    return t(table).filter(F.col(column) >= month)


def _months(t: Tables, table: str, months: set[str] | None, column: str) -> DataFrame:
    """Some months of a table (None: all); constants again. ``NO_VALUE`` stands for the rows without a month."""
    if months is None:
        return t(table)
    named = F.col(column).isin(sorted(months - {NO_VALUE}))
    return t(table).filter(named | F.col(column).isNull() if NO_VALUE in months else named)


def _visits(t: Tables, as_of: date, rules: Rules) -> DataFrame:
    # The month before the window too: a visit may count a day later than it was made.
    first = window_month(as_of, 3)
    return visits.visit_calls(
        _since(t, "FactVisitList", first, "visit_ym"), _since(t, "FactActualVisit", first, "visit_ym"), t("DimRoute"),
        as_of=as_of, rules=rules)


def _coolers(t: Tables, months: set[str] | None, rules: Rules) -> DataFrame:
    return assets.cooler_sales(
        _months(t, "FactDataAsset", months, "YM"), _months(t, "AggInvVolByBrandYM", months, "ym"), rules=rules)


def _card(t: Tables, months: set[str] | None, rules: Rules, parity: bool) -> DataFrame:
    return scorecard.scorecard(
        _months(t, "AggInvVolByBrandYM", months, "ym"), _months(t, "AggInvBillBrandYM", months, "ym"),
        _months(t, "AggVisitCallYM", months, "ym"), _months(t, "AggActOutletYM", months, "ym"),
        _months(t, "AggAssetCoolerYM", months, "ym"), t("DimChannel"), t("Config"), t("DimCustomer"), t("DimCustGrp1"),
        rules=rules, parity=parity)


STEPS = [
    Step("AggInvVolByBrandYM", lambda t, as_of, rules: volume.volume_by_brand(
        t("FactAllDataInvoice"), t("DimReason"), t("DimCustomer"), t("DimMaterial"), as_of=as_of, rules=rules,
        last_days=t(LAST_DAYS).select("LastDay")), 5),
    Step("AggInvBillBrandYM", _sales(volume.bills), 5),
    Step("AggInvByBrandYM", _sales(volume.bills_by_brand), 5),
    Step("AggVisitCallYM", _visits, 2),
    Step("AggActOutletYM", lambda t, as_of, rules: outlets.active_outlets(
        t("FactAllDataInvoice"), t("FactCustPerMonPlan"), t("DimReason"), t("DimChannel"), t("Config"),
        t("DimMaterial"), t("DimCustomer"), t("DimCustGrp1"), t("DimRoute"), t("DimLocation"),
        as_of=as_of, rules=rules), 0),
    Step("AggDataAssetYM", lambda t, as_of, rules: assets.asset_counts(t("FactDataAsset")), None),
]
# Tables made of stored months of others: table -> source and its month column. Only months that differ are made again.
DERIVED = {
    "AggAssetCoolerYM": {"FactDataAsset": "YM", "AggInvVolByBrandYM": "ym"},
    "AggInvAllDataYM": {
        "AggInvVolByBrandYM": "ym", "AggInvBillBrandYM": "ym", "AggVisitCallYM": "ym", "AggActOutletYM": "ym",
        "AggAssetCoolerYM": "ym"},
}


def refresh_aggregates(
    mart: Mart, as_of: date, *, rules: Rules = DEFAULT_RULES, only: set[str] | None = None, parity: bool = False,
    rebuild: bool = False,
) -> dict[str, int]:
    """Rebuild the aggregates; returns rows written per table. A second run changes nothing.

    Cooler sales and the scorecard are replaced for the months in which a source has other files than those they were
    made of: the windows replaced above, and whatever a load wrote into older months. ``rebuild`` makes them over all months, as after
    a change of dimensions that is to reach back. ``parity`` repeats side measures as the scorecard says.
    """
    written, sort = {}, ("BranchCode", "RouteCode")

    def put(table: str, rows: DataFrame, months: int | None) -> None:
        rows = with_month(dims.stamped(rows))
        if months is None or not mart.exists(table):
            written[table] = mart.overwrite(table, rows, "ym", sort)
        else:
            written[table] = mart.replace_window(table, rows, "ym", window_month(as_of, months), sort)
    for step in STEPS:
        if only is None or step.table in only:
            put(step.table, step.build(mart.read, as_of, rules), step.months)
    for table, sources in DERIVED.items():
        if only is None or table in only:
            seen = {source: states(mart, source, key) for source, key in sources.items()}
            months = None if rebuild else changed(mart, table, seen)
            rows = _coolers(mart.read, months, rules) if table == "AggAssetCoolerYM" else _card(mart.read, months, rules, parity)
            if months is None:
                put(table, rows, None)
            elif months:
                # Rows without a month get the date key "01" in the cooler table.
                ours = months | {"01"} if table == "AggAssetCoolerYM" and NO_VALUE in months else months
                written[table] = mart.replace_values(table, with_month(dims.stamped(rows)), "ym", ours, sort)
            else:
                written[table] = 0
            remember(mart, table, seen)
    return written
