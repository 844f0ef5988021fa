"""The registered queries as SQL over the same tables, written join by join."""

from __future__ import annotations

import re

from checks.registry import COPIES, DISTINCT, FILLED, MIRRORED
from checks.roles import CHANNELS, SINCE, TEST_RULES
from martloom import schemas

# -- role views -----------------------------------------------------------------------

_CHANNELS = ", ".join(f"('{k}', '{v}')" for k, v in CHANNELS.items())
_CONFIG = ", ".join(f"('{v}', '{'Post-Mix' if v == 'Post-Mix' else 'Normal'}')" for v in CHANNELS.values())

VIEWS = {
    "d_material": """
        SELECT CAST(p_partkey AS VARCHAR) AS Material, p_name AS BasicMaterial, p_brand AS BrandDesc,
               p_brand AS BrandDescription, p_type AS MatType1,
               CASE WHEN p_type = 'PROMO' THEN 'Z99' ELSE 'Z31' END AS MaterialType,
               CASE WHEN p_size <= 40 THEN 1 ELSE 3 END AS MatType1Id,
               CASE p_partkey % 3 WHEN 0 THEN 'NR' WHEN 1 THEN 'RB' ELSE 'CN' END AS PackagingType,
               CASE WHEN p_type = 'LARGE' THEN 'PostMix' ELSE '' END AS GroupPostMix,
               CAST(p_size AS DECIMAL(10,2)) * 0.01 AS Litre, p_size AS CubeConvert
        FROM part""",
    "d_customer": """
        SELECT 1 AS HANAFlag, CAST(c_custkey AS VARCHAR) AS Customer, c_nationkey + 120 AS CustGrp1,
               CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Other' ELSE 'Special' END AS SpecialGrp1,
               CASE WHEN c_custkey % 10 = 0 THEN 'Other' ELSE 'Customer store' END AS CustType
        FROM customer""",
    "d_group": """
        SELECT n_nationkey + 120 AS CustGrp,
               CASE n_regionkey WHEN 0 THEN 'FSR' WHEN 1 THEN 'Provision' WHEN 2 THEN 'Other' WHEN 3 THEN 'CVM'
                    ELSE 'Employee' END AS ShopType
        FROM nation""",
    "d_channel": f"SELECT * FROM (VALUES {_CHANNELS}) t(ChannelMarge, SalesOfficeDesc)",
    "d_config": f"SELECT * FROM (VALUES {_CONFIG}) t(Value1, Value2)",
    "d_reason": "SELECT * FROM (VALUES (''), ('101'), ('601')) t(ReasonCode)",
    "d_route": """
        SELECT CAST(s_suppkey AS VARCHAR) AS Route, CASE WHEN s_suppkey % 2 = 0 THEN 'PS' ELSE 'CS' END AS SalesType1,
               CAST(s_nationkey AS VARCHAR) AS BranchVL
        FROM supplier""",
    "d_location": """
        SELECT CAST(n_nationkey AS VARCHAR) AS BranchCode, n_nationkey % 2 AS PxIncludeFlag FROM nation""",
    "raw_line": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS disc,
               CAST(l_tax AS DECIMAL(4,2)) AS tax
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "f_invoice": """
        SELECT 1 AS HANAFlag, CAST(s_nationkey AS VARCHAR) AS Branch, strftime(o_orderdate, '%Y%m') AS YM,
               strftime(o_orderdate, '%Y%m%d') AS DateKey, o_orderdate AS BillingDate,
               CAST(l_suppkey AS VARCHAR) AS Route, CAST(l_suppkey AS VARCHAR) AS VL, c_mktsegment AS ChannelMarge,
               CASE WHEN l_returnflag = 'R' THEN 'CN' ELSE 'TaxInv' END AS BType,
               CAST(l_suppkey % 7 AS VARCHAR) AS Salesman, CAST(o_custkey AS VARCHAR) AS Customer,
               CAST(o_orderkey AS VARCHAR) AS Documents, CAST(l_partkey AS VARCHAR) AS Material,
               CASE o_orderpriority WHEN '5-LOW' THEN '601' WHEN '4-NOT SPECIFIED' THEN '101' ELSE '' END
                   AS ReasonCode,
               l_linestatus AS DataSource, CAST(l_quantity * 2 AS DECIMAL(18,4)) AS SoldSingle,
               CAST(l_quantity AS DECIMAL(18,4)) AS SoldBaseQty,
               CAST(l_quantity / p_size AS DECIMAL(18,4)) AS SoldCase,
               CAST(l_linenumber * 2 AS DECIMAL(18,4)) AS FreeSingle,
               CAST(l_linenumber AS DECIMAL(18,4)) AS FreeBaseQty,
               CAST(l_linenumber / p_size AS DECIMAL(18,4)) AS FreeCase,
               CAST(price * (1 - disc) AS DECIMAL(18,4)) AS NetItemAmt,
               CAST(price * (1 - disc) * tax AS DECIMAL(18,4)) AS VatAmt,
               CAST(price * (1 - disc) AS DECIMAL(18,4)) + CAST(price * (1 - disc) * tax AS DECIMAL(18,4)) AS TotalAmt,
               CAST(price * disc AS DECIMAL(18,4)) AS Discount, l_shipdate AS ETLLoadData, l_returnflag AS flag
        FROM raw_line""",
    "f_plan": """
        SELECT YM, Branch, Route, Customer, CAST(count(*) AS INTEGER) AS CustomerTotal,
               CAST(min(BillingDate) AS DATE) AS FirstDay
        FROM f_invoice WHERE flag <> 'A' GROUP BY ALL""",
    "f_visit": """
        SELECT CAST(s_nationkey AS VARCHAR) AS Branch, CAST(l_suppkey AS VARCHAR) AS Route,
               CAST(l_suppkey % 7 AS VARCHAR) AS Salesman, CAST(o_custkey AS VARCHAR) AS Customer,
               o_orderdate AS AssignedDate, l_shipdate AS VisitDate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "f_asset": """
        SELECT strftime(o_orderdate, '%Y%m') AS YM, CAST(o_custkey % 25 AS VARCHAR) AS BranchByAsset,
               CAST(o_custkey AS VARCHAR) AS Customer,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'cooler' ELSE 'rack' END AS AssetType,
               o_orderpriority AS AssetSubType, o_orderstatus AS AssetStatus,
               CAST(o_custkey % 2 AS VARCHAR) AS ActiveStatus, CAST(o_orderkey AS VARCHAR) AS AssetCode,
               o_orderdate AS ETLLoadData
        FROM orders""",
    "f_asset_plan": """
        SELECT a.*, p.Branch AS BranchByVP, p.Route AS VPRoute
        FROM f_asset a LEFT JOIN f_plan p ON p.YM = a.YM AND p.Customer = a.Customer""",
}


def with_views(body: str, extra: dict[str, str] | None = None, base: dict[str, str] | None = None) -> str:
    """Prefix a statement with the views it uses, directly or through other views.

    ``base={}`` leaves the role views out, for a database that holds them as tables.
    """
    views = (VIEWS if base is None else base) | (extra or {})
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, text in views.items():
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(text)
                if name not in needed:
                    needed.append(name)
    visit(body)
    ctes = ", ".join(f"{name} AS ({views[name]})" for name in needed)
    return f"WITH {ctes} {body}" if needed else body


def doubles(names: list[str], source: str = "") -> str:
    return ", ".join(f"CAST({source}{n} AS DOUBLE) AS {n}" for n in names)


# -- invoice aggregates -----------------------------------------------------------------

_BRANDS = ", ".join(f"'{b}'" for b in TEST_RULES.brands.values())
_BUCKET = f"CASE WHEN BrandDesc IN ({_BRANDS}) THEN BrandDesc ELSE 'Other Brand' END"
_EXCLUDED = "(-2, 131, 132, 134, 139, 340, 345)"
_LINES = f"""
    FROM f_invoice i
    JOIN d_reason r ON i.ReasonCode = r.ReasonCode AND left(r.ReasonCode, 1) <> '6'
    JOIN d_customer c ON i.HANAFlag = c.HANAFlag AND i.Customer = c.Customer AND c.CustGrp1 NOT IN {_EXCLUDED}
    LEFT JOIN d_material m ON i.Material = m.Material"""
_SOLD = """MaterialType = 'Z31' AND MatType1Id IN (1, 8) AND PackagingType IN ('NR', 'RB')
      AND GroupPostMix <> 'PostMix'"""
_HEAD = """i.HANAFlag, YM || '01' AS DateKey, Branch AS BranchCode, Route AS RouteCode, Salesman,
    ChannelMarge AS ChannelSalesOffice, i.Customer AS CustomerCode, DataSource, BType AS BillType"""
_BILL_SUMS = """sum(SoldSingle) AS SoldSingle, sum(SoldCase) AS SoldCase, sum(SoldBaseQty) AS SoldBaseQty,
    sum(SoldBaseQty * Litre) AS SoldLitre, sum(FreeCase) AS FreeCase, sum(FreeBaseQty) AS FreeBaseQty,
    sum(FreeBaseQty * Litre) AS FreeLitre, sum(NetItemAmt) AS NetItemAmt, sum(VatAmt) AS VatAmt,
    sum(TotalAmt) AS TotalAmount, sum(Discount) AS Discount"""
_BILL_NAMES = ["SoldSingle", "SoldCase", "SoldBaseQty", "SoldLitre", "FreeCase", "FreeBaseQty", "FreeLitre",
               "NetItemAmt", "VatAmt", "TotalAmount", "Discount"]
_VOLUME_NAMES = ["SoldSingle", "SoldCase", "SoldCaseLastDay", "SoldBaseQty", "SoldLitre", "FreeSingle", "FreeCase",
                 "FreeCaseLastDay", "FreeBaseQty", "FreeLitre", "NetItemAmt", "VatAmt", "TotalAmount", "Discount"]


def _where(months_from: str | None) -> str:
    return f"WHERE {_SOLD}" + (f" AND YM >= '{months_from}'" if months_from else "")


def volume_view(months_from: str | None) -> str:
    return f"""
    SELECT {_HEAD}, BasicMaterial, BrandDesc, {_BUCKET} AS Brand, MatType1,
        sum(SoldSingle) AS SoldSingle, sum(SoldCase) AS SoldCase,
        sum(CASE WHEN d.LastDay IS NOT NULL THEN SoldCase ELSE 0 END) AS SoldCaseLastDay,
        sum(SoldBaseQty) AS SoldBaseQty, sum(SoldBaseQty * Litre) AS SoldLitre, sum(FreeSingle) AS FreeSingle,
        sum(FreeCase) AS FreeCase, sum(CASE WHEN d.LastDay IS NOT NULL THEN FreeCase ELSE 0 END) AS FreeCaseLastDay,
        sum(FreeBaseQty) AS FreeBaseQty, sum(FreeBaseQty * Litre) AS FreeLitre, sum(NetItemAmt) AS NetItemAmt,
        sum(VatAmt) AS VatAmt, sum(TotalAmt) AS TotalAmount, sum(Discount) AS Discount
    {_LINES}
    LEFT JOIN (SELECT max(DateKey) AS LastDay FROM f_invoice GROUP BY YM) d ON i.DateKey = d.LastDay
    {_where(months_from)} GROUP BY ALL"""


def bills_view(months_from: str | None, between: str = "|") -> str:
    def count(test: str, what: str) -> str:
        return f"CASE WHEN {test} THEN count(DISTINCT {what}) ELSE 0 END"
    tax, other, pair = "BType = 'TaxInv'", "BType <> 'TaxInv'", f"concat(BasicMaterial, '{between}', Documents)"
    return f"""
    SELECT {_HEAD}, {count(tax, 'Documents')} AS NoOfBill, {count(other, 'Documents')} AS NoOfBillCN,
        {count(tax, pair)} AS NoOfBrand, {count(other, pair)} AS NoOfBrandCN, {_BILL_SUMS}
    {_LINES} {_where(months_from)}
    GROUP BY i.HANAFlag, YM, Branch, Route, Salesman, ChannelMarge, i.Customer, DataSource, BType"""


def brand_bills_view(months_from: str | None) -> str:
    return f"""
    SELECT {_HEAD}, BrandDescription, {_BUCKET} AS Brand,
        CASE WHEN BType = 'TaxInv' THEN count(DISTINCT Documents) ELSE 0 END AS NoOfBrandBill,
        CASE WHEN BType <> 'TaxInv' THEN count(DISTINCT Documents) ELSE 0 END AS NoOfBrandBillCN, {_BILL_SUMS}
    {_LINES} {_where(months_from)}
    GROUP BY i.HANAFlag, YM, Branch, Route, Salesman, ChannelMarge, i.Customer, DataSource, BType,
        BrandDescription, {_BUCKET}"""


_KEYS = """HANAFlag, DateKey, BranchCode, RouteCode, Salesman, ChannelSalesOffice, CustomerCode, DataSource,
    BillType"""

# -- visits -----------------------------------------------------------------------------


def visits_view(months_from: str | None) -> str:
    """Plan and actual as one list of marked visits, counted per customer first."""
    def side(day: str, plan: int) -> str:
        shift = "CASE SalesType1 WHEN 'PS' THEN 1 ELSE 0 END"
        return f"""SELECT v.Branch, v.Route, v.Salesman, Customer, {plan} AS planned, {1 - plan} AS made,
            strftime({day} + to_days({shift}), '%Y%m') AS M FROM f_visit v LEFT JOIN d_route r USING (Route)"""
    keep = f"WHERE M >= '{months_from}'" if months_from else ""
    # A key with a NULL stays, but is met by no visit.
    met = "CASE WHEN (M || Branch || Route || Salesman || Customer) IS NOT NULL THEN "
    return f"""
    SELECT Branch AS BranchCode, Route AS RouteCode, Salesman, concat(M, '01') AS DateKey,
        count_if(p > 0) AS CustomerPlanVisit, count_if(a > 0) AS CustomerActualVisit,
        count_if(least(p, a) > 0) AS CustomerVisitOnPlan,
        CAST(sum(p) AS BIGINT) AS NoOfPlanVisit, CAST(sum(a) AS BIGINT) AS NoOfActualVisit
    FROM (SELECT M, Branch, Route, Salesman, Customer, {met}sum(planned) ELSE 0 END AS p, {met}sum(made) ELSE 0 END AS a
          FROM ({side('AssignedDate', 1)} UNION ALL {side('VisitDate', 0)}) {keep}
          GROUP BY M, Branch, Route, Salesman, Customer)
    GROUP BY ALL"""


# -- outlets ----------------------------------------------------------------------------

_B = TEST_RULES.brands
_FAMILY = f"starts_with(BrandDesc, '{TEST_RULES.brand_family}')"
# Marks of a buyer, by output column: what at least one sale must be.
_MARKS = {
    "EstActiveOutletVL": f"BrandDesc = '{_B['Est']}'", "CrystalActiveOutletVL": f"BrandDesc = '{_B['Crystal']}'",
    "OishiActiveOutletVL": _FAMILY, "OishiGreenTeaActiveOutletVL": f"BrandDesc = '{_B['OishiGreenTea']}'",
    "OishiChakulzaActiveOutletVL": f"BrandDesc = '{_B['OishiChakulza']}'",
    "WrangyerActiveOutletVL": f"BrandDesc = '{_B['Wrangyer']}'",
    "FSRRBActiveOutletVL": "ShopType = 'FSR' AND PackagingType = 'RB'", "ActiveBrandOutletVLExOishi": f"NOT {_FAMILY}",
}
OUTLET_VIEWS = {
    # Customers that count as outlets, and what they are.
    "o_shop": "SELECT HANAFlag, Customer, CustGrp, ShopType, SpecialGrp1 FROM d_customer LEFT JOIN d_group ON CustGrp1 = CustGrp",
    # The distinct sales of counting goods to outlets; post-mix sales are marked.
    "o_sale": f"""
        SELECT DISTINCT i.YM, i.Customer, s.ShopType, m.BrandDesc, m.PackagingType, i.Branch, i.VL, h.mixed
        FROM f_invoice i SEMI JOIN d_reason r ON r.ReasonCode = i.ReasonCode AND r.ReasonCode = ''
        JOIN d_material m USING (Material) JOIN o_shop s USING (HANAFlag, Customer)
        JOIN (SELECT ChannelMarge, Value2 = 'Post-Mix' AS mixed FROM d_channel, d_config WHERE SalesOfficeDesc = Value1
              AND Value1 IN ('Direct Sales', 'Presales', 'Online', 'Post-Mix', 'Vending')) h USING (ChannelMarge)
        WHERE i.BType = 'TaxInv' AND {_SOLD} AND ShopType NOT IN ('CVM', 'Employee') AND SpecialGrp1 IN ('', 'Other')
          AND NOT starts_with(i.Customer, 'E') AND CustGrp NOT IN {_EXCLUDED}""",
    # Sales that stay at their branch: post-mix only where the branch includes it.
    "o_bought": """
        SELECT DISTINCT YM, Customer, ShopType, Branch FROM o_sale
        WHERE NOT mixed OR Branch IN (SELECT BranchCode FROM d_location WHERE PxIncludeFlag <> 0)""",
    "o_total": """
        SELECT YM, Branch, Route, ShopType, count(Customer) AS TotalOutlet FROM (
            SELECT DISTINCT strftime(last_day(strptime(YM, '%Y%m')) + 1, '%Y%m') AS YM, Branch, Route, ShopType, p.Customer
            FROM f_plan p LEFT JOIN o_shop s ON s.Customer = p.Customer AND s.HANAFlag = 1) GROUP BY ALL""",
    "o_onplan": """
        SELECT DISTINCT b.YM, coalesce(p.Branch, b.Branch) AS BranchCode, p.Route AS RouteCode, b.ShopType, b.Customer,
            p.Branch AS planned
        FROM o_bought b JOIN f_plan p USING (YM, Customer)""",
    # Buyers on their planned route with its total, buyers without a plan, totals nobody met.
    "o_active": """
        SELECT YM || '01' AS DateKey, BranchCode, RouteCode, ShopType, max(TotalOutlet) AS TotalOutletVP,
            count(DISTINCT Customer) AS ActiveOutletVP
        FROM (
            SELECT n.* EXCLUDE planned, TotalOutlet FROM o_onplan n LEFT JOIN o_total t
              ON t.YM = n.YM AND t.Branch = n.planned AND t.Route = n.RouteCode AND t.ShopType = n.ShopType
            UNION ALL
            SELECT YM, Branch, '', ShopType, Customer, NULL FROM o_bought b ANTI JOIN f_plan p USING (YM, Customer)
            UNION ALL
            SELECT YM, Branch, '', NULL, NULL, TotalOutlet FROM o_total t ANTI JOIN o_onplan n
              ON t.YM = n.YM AND t.Branch = n.planned AND t.Route = n.RouteCode AND t.ShopType = n.ShopType
            WHERE ShopType IS NOT NULL)
        GROUP BY ALL""",
    # One row per key and buyer, with marks and number of brands; then counted.
    "o_marked": f"""
        SELECT YM || '01' AS DateKey, coalesce(BranchVL, '') AS BranchCode, coalesce(VL, '') AS RouteCode, ShopType, Customer,
            count(DISTINCT coalesce(BrandDesc, '')) AS brands,
            {", ".join(f"bool_or(coalesce({test}, false)) AS {name}" for name, test in _MARKS.items())}
        FROM o_sale LEFT JOIN d_route ON Route = VL
        WHERE NOT mixed OR BranchVL IN (SELECT BranchCode FROM d_location WHERE PxIncludeFlag <> 0) GROUP BY ALL""",
    "o_brand": f"""
        SELECT DateKey, BranchCode, RouteCode, ShopType, {", ".join(f"count_if({name}) AS {name}" for name in _MARKS)},
            count(*) AS ActiveBrandOutletVL, sum(brands) AS NoOfBrandOutletVL
        FROM o_marked GROUP BY ALL""",
}
_OUTLET_COUNTS = ["TotalOutletVP", "ActiveOutletVP", "EstActiveOutletVL", "CrystalActiveOutletVL",
                  "OishiActiveOutletVL", "OishiGreenTeaActiveOutletVL", "OishiChakulzaActiveOutletVL",
                  "WrangyerActiveOutletVL", "FSRRBActiveOutletVL", "ActiveBrandOutletVL", "NoOfBrandOutletVL",
                  "ActiveBrandOutletVLExOishi"]


def outlets_view(months_from: str | None) -> str:
    keep = f"WHERE DateKey >= '{months_from}01'" if months_from else ""
    whole = "DateKey IS NOT NULL AND BranchCode IS NOT NULL AND RouteCode IS NOT NULL AND ShopType IS NOT NULL"
    sums = ", ".join(f"CAST(sum({c}) FILTER ({whole}) AS BIGINT) AS {c}" for c in _OUTLET_COUNTS)
    return f"""
    SELECT DateKey, BranchCode, RouteCode, ShopType, {sums}
    FROM (SELECT * FROM o_active UNION ALL BY NAME SELECT * FROM o_brand) {keep} GROUP BY ALL"""


# -- assets and scorecard ---------------------------------------------------------------

COOLER = f"""
    SELECT DISTINCT p.YM || '01' AS DateKey, p.BranchCode, coalesce(p.RouteCode, '') AS RouteCode,
        p.Customer AS CustomerCode, k.AssetSubType, k.kind AS NoOfCooler,
        -- The exact share in units of 0.0001, rounded half away from zero and read as a number.
        CAST(CASE WHEN p.sold < 0 THEN '-' ELSE '' END || CAST((units + here) // (2 * here) // 10000 AS VARCHAR) || '.'
          || lpad(CAST((units + here) // (2 * here) % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS AmountByAsset
    FROM (SELECT a.YM, coalesce(BranchByVP, BranchByAsset) AS BranchCode, VPRoute AS RouteCode, a.Customer,
            count(*) OVER (PARTITION BY a.YM, coalesce(BranchByVP, BranchByAsset), VPRoute, a.Customer) AS here,
            (SELECT sum(TotalAmount) FROM g_volume g WHERE g.CustomerCode = a.Customer
              AND left(g.DateKey, 6) = a.YM AND BrandDesc IS DISTINCT FROM '{TEST_RULES.cooler_excluded_brand}') AS sold
          FROM f_asset_plan a WHERE AssetType = 'cooler') p
    LEFT JOIN (SELECT YM, Customer, AssetSubType, count(*) OVER (PARTITION BY YM, Customer, AssetSubType) AS kind
               FROM f_asset_plan WHERE AssetType = 'cooler') k USING (YM, Customer),
    LATERAL (SELECT 2 * k.kind * CAST(abs(CAST(p.sold AS DECIMAL(38,4))) * 10000 AS HUGEINT) AS units)"""

_LABELS = {
    "Est": f"Brand = '{_B['Est']}'", "Crystal": f"Brand = '{_B['Crystal']}'",
    "Oishi": f"Brand LIKE '{TEST_RULES.brand_family}%'", "Wrangyer": f"Brand = '{_B['Wrangyer']}'",
    "OtherBrand": "Brand = 'Other Brand'",
}
_PARTS = {"Case": "SoldCase", "CaseLastDay": "SoldCaseLastDay", "Litre": "SoldLitre", "NetAmount": "NetItemAmt",
          "TotalAmount": "TotalAmount"}
_WIDE = ", ".join(
    f"sum(CASE WHEN {test} THEN {m} ELSE 0 END) AS {label}{part}"
    for label, test in _LABELS.items() for part, m in _PARTS.items()
) + ", " + ", ".join(f"sum({m}) AS TotalBrand{part}" for part, m in _PARTS.items())
_WIDE_NAMES = [f"{label}{part}" for label in [*_LABELS, "TotalBrand"] for part in _PARTS]
_STORES = """(SELECT HANAFlag, Customer AS CustomerCode FROM d_customer LEFT JOIN d_group ON CustGrp1 = CustGrp
    WHERE CustType = 'Customer store' AND ShopType NOT IN ('CVM', 'Employee') AND SpecialGrp1 IN ('', 'Other')
      AND NOT starts_with(Customer, 'E') AND CustGrp NOT IN (-2, 131))"""
_SOLD_THROUGH = """(SELECT ChannelMarge AS ChannelSalesOffice, CAST(coalesce(Value2 = 'Post-Mix', false) AS INTEGER) AS mix
    FROM d_channel, d_config WHERE SalesOfficeDesc = Value1)"""


def scorecard_sql(parity: bool, base: dict[str, str] | None = None) -> str:
    """Every source adds rows of its measures under the three keys; the rows are summed once."""
    side = ["TotalOutletVP", "ActiveOutletVP", "ActiveBrandOutletVL", "NoOfBrandOutletVL", "NoOfPlanVisit",
            "NoOfActualVisit", "NoOfBill", "NoOfBrand"]
    keys = "DateKey, BranchCode, RouteCode"
    outlet_side, visit_side = ", ".join(side[:4]), ", ".join(side[4:6])
    whole = "(DateKey || BranchCode || RouteCode) IS NOT NULL"
    times = "greatest(count(DISTINCT mix), 1)" if parity else "1"
    views = {
        "g_volume": volume_view(None), "g_bills": bills_view(None), "g_visits": visits_view(None),
        "g_outlets": outlets_view(None), "g_coolers": COOLER, **OUTLET_VIEWS,
        "s_rows": f"""
            SELECT {keys}, true AS opens, mix, {_WIDE} FROM g_volume JOIN {_SOLD_THROUGH} USING (ChannelSalesOffice)
                JOIN {_STORES} USING (HANAFlag, CustomerCode) GROUP BY {keys}, mix
            UNION ALL BY NAME
            SELECT {keys}, false AS opens, sum(NoOfBill - NoOfBillCN) AS NoOfBill, sum(NoOfBrand - NoOfBrandCN) AS NoOfBrand
                FROM g_bills JOIN {_SOLD_THROUGH} USING (ChannelSalesOffice)
                JOIN {_STORES} USING (HANAFlag, CustomerCode) GROUP BY {keys}
            UNION ALL BY NAME SELECT {keys}, true AS opens, {visit_side} FROM g_visits
            UNION ALL BY NAME SELECT {keys}, true AS opens, {outlet_side} FROM g_outlets
            UNION ALL BY NAME
            SELECT DISTINCT {keys}, true AS opens FROM g_coolers WHERE CustomerCode IN (
                SELECT Customer FROM o_shop WHERE HANAFlag = 1 AND ShopType IN ('FSR', 'Provision', 'Other'))""",
    }
    body = f"""
    SELECT {keys}, coalesce(max(mix) FILTER ({whole}), 0) AS PostMixFlag,
        {", ".join(f"CAST(sum({n}) FILTER ({whole}) AS DOUBLE) AS {n}" for n in _WIDE_NAMES)},
        {", ".join(f"CAST(sum({n}) FILTER ({whole}) * {times} AS BIGINT) AS {n}" for n in side)}
    FROM s_rows GROUP BY {keys} HAVING bool_or(opens)"""
    return with_views(body, views, base)


# -- facts, targets, dimensions ----------------------------------------------------------

_NULLS = ("Channel", "ChannelVSMS", "SalesOffice", "PromotionCode")


def invoice_sql(where: str) -> str:
    given = {c: f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULLS}
    given |= {c: f"Customer AS {c}" for c in ("SoldTo", "BillTo", "Payer", "ShipTo")}
    given |= {"DOCUMENT_NUMBER": "Documents AS DOCUMENT_NUMBER"}
    given |= {c: f"CAST({c} AS VARCHAR) AS {c}" for c in ("BillingDate", "ETLLoadData")}
    kinds = {f.name: f.dataType.simpleString() for f in schemas.schema("FactAllDataInvoice").fields}
    given |= {c: f"CAST({c} AS DOUBLE) AS {c}" for c, kind in kinds.items() if kind.startswith("decimal")}
    return with_views(f"SELECT {', '.join(given.get(c, c) for c in kinds)} FROM f_invoice {where}")


def _asset_sql(where: str) -> str:
    made = {c: f"CAST(NULL AS VARCHAR) AS {c}" for c in ("AssetQRCode", "AssetDesc", "AssetEquipmentNo",
                                                         "AssetSerialNo")}
    made["ETLLoadData"] = "CAST(ETLLoadData AS VARCHAR) AS ETLLoadData"
    names = schemas.columns("FactDataAsset")
    return with_views(f"SELECT {', '.join(made.get(c, c) for c in names)} FROM f_asset_plan {where}")


def _visit_sql(day: str, where: str) -> str:
    return with_views(f"""SELECT Branch, Route, Salesman, Customer, CAST({day} AS VARCHAR) AS {day},
        CAST({day} AS VARCHAR) AS ETLLoadData FROM f_visit {where}""")


def _targets_view(status: str | None = None, priority: str | None = None) -> str:
    keep = f"WHERE o_orderstatus = '{status}'" if status else f"WHERE o_orderpriority = '{priority}'" if priority else ""
    return f"""SELECT strftime(o_orderdate, '%Y%m') AS YM, CAST(c_nationkey AS VARCHAR) AS Branch,
        o_orderpriority AS Brand, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS AOP,
        sum(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(12,1))) AS AOPLY
        FROM orders JOIN customer ON o_custkey = c_custkey {keep} GROUP BY ALL"""


_BRANCH = """YM, Branch, CAST(NULL AS VARCHAR) AS SubBranch, CAST(NULL AS VARCHAR) AS BranchDesc, Brand,
    'FSR' AS ShopType, CAST(AOPLY AS DOUBLE) AS AOPLY, CAST(AOP AS DOUBLE) AS AOP"""
_ROUTE = """YM, Branch AS Route, Brand, 'FSR' AS ShopType, CAST(AOPLY AS DOUBLE) AS AOPLYRoute,
    CAST(AOP AS DOUBLE) AS AOPRoute"""
_MANAGER_VIEW = """SELECT strftime(o_orderdate, '%Y%m') AS YM, CAST(l_suppkey % 10 AS VARCHAR) AS TDMID,
    l_returnflag AS Brand, sum(CAST(l_quantity AS DECIMAL(12,2))) AS AOP, count(*) AS LY
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""
_MANAGER = """'Manager ' || TDMID AS TDMName, TDMID, 'FSR' AS ShopType, YM, Brand, 'Volume' AS TargetType,
    CAST(LY AS DOUBLE) AS LY, CAST(AOP AS DOUBLE) AS AOP"""


def _replaced(columns: str, keys: list[str]) -> str:
    on = " AND ".join(f"n.{k} = o.{k}" for k in keys)
    return f"""WITH o AS ({_targets_view('F')}), n AS ({_targets_view('O')})
        SELECT {columns} FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE {on}) UNION ALL SELECT {columns} FROM n"""


def _daily(stale: str) -> str:
    def totals(keep: str) -> str:
        return f"""SELECT strftime(o_orderdate, '%Y%m%d') AS DateKey, CAST(o_orderdate AS DATE) AS day,
            count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS amt FROM orders {keep} GROUP BY ALL"""
    out = 'DateKey, CAST(day AS VARCHAR) AS ETLLoadData, n AS "Rows", CAST(amt AS DOUBLE) AS Amount'
    return f"""SELECT {out} FROM ({totals("WHERE o_orderstatus = 'F'")}) WHERE NOT ({stale})
        UNION ALL SELECT {out} FROM ({totals('')}) WHERE {stale}"""


def _filled_sql(table: str) -> str:
    source, key, given = FILLED[table]

    def made(name: str, kind: str) -> str:
        if name in given:
            return f"{given[name]} AS {name}"
        if kind == "string":
            return f"'{name}-' || CAST({key} AS VARCHAR) AS {name}"
        if kind == "timestamp":
            return f"'2001-08-01 00:00:00' AS {name}"
        if kind == "date":
            return f"'2001-08-01' AS {name}"
        return f"CAST({key} % 10 AS INTEGER) AS {name}" if kind == "int" else f"CAST({key} % 100 AS DOUBLE) AS {name}"
    fields = [(f.name, f.dataType.simpleString()) for f in schemas.schema(table).fields]
    rows = f"(SELECT DISTINCT {key} FROM {source})" if table in DISTINCT else source
    return f"SELECT {', '.join(made(n, k) for n, k in fields)} FROM {rows}"


_SQUARE = "{x} >= x0 AND {x} < x0 + 22 AND {y} >= y0 AND {y} < y0 + 20"
_HOLE = "{x} >= x0 + 4 AND {x} < x0 + 12 AND {y} >= y0 + 4 AND {y} < y0 + 12"
_HALF = "{x} >= x0 AND {y} >= y0 AND {y} < y0 + 20 AND {x} < (x0 - (x0 + 20)) * ({y} - y0) / ((y0 + 20) - y0) + (x0 + 20)"
_TERRITORY = """SELECT *, -10.0::DOUBLE + (n_nationkey % 5) * 22.0::DOUBLE AS x0,
    (n_nationkey // 5) * 20.0::DOUBLE AS y0 FROM nation"""


def _within(x: str, y: str) -> str:
    square, hole, half = (t.format(x=x, y=y) for t in (_SQUARE, _HOLE, _HALF))
    return f"""(CASE n_regionkey WHEN 0 THEN {square} AND NOT ({hole}) WHEN 1 THEN {half} ELSE {square} END)"""


def _region_columns(prefix: str = "") -> str:
    return f"""CAST(n_regionkey AS VARCHAR) AS PointRegion, n_name AS PointProvinceTH, lower(n_name) AS PointProvinceEN,
    n_name AS PointAmphoeTH, lower(n_name) AS PointAmphoeEN, n_name AS PointTambonTH, lower(n_name) AS PointTambonEN"""


def _customer_sql(geo: bool) -> str:
    old = {
        "HANAFlag": "0", "OldCustomer": "''", "Customer": "CAST(c_custkey AS VARCHAR)",
        "CustomerDesc": "lower(c_name)",
        "CustomerDescription": "CAST(c_custkey AS VARCHAR) || ' - ' || lower(c_name)", "CustType": "'10'",
        "CustGrp1": "CAST(c_nationkey + 120 AS VARCHAR)", "ETLLoadData": "'2001-08-01'",
        "LONGITUDE": "(c_acctbal + 1000.0::DOUBLE) / 110.0::DOUBLE", "LATITUDE": "(c_custkey % 500) / 5.0::DOUBLE",
    }
    new = {
        "HANAFlag": "1", "OldCustomer": "'O' || CAST(c_custkey AS VARCHAR)",
        "Customer": "CAST(c_custkey AS VARCHAR)", "CustomerDesc": "c_name",
        "CustomerDescription": "CAST(c_custkey AS VARCHAR) || ' - ' || c_name", "CustType": "'Customer store'",
        "CustGrp1": "CAST(c_nationkey + 120 AS VARCHAR)", "ETLLoadData": "'2001-08-01'",
        "LONGITUDE": "CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100.0::DOUBLE END",
        "LATITUDE": "(c_custkey % 1000) / 10.0::DOUBLE",
    }
    fields = [(f.name, f.dataType.simpleString()) for f in schemas.schema("DimCustomer").fields
              if not f.name.startswith("Point")]
    nothing = {n: f"CAST(NULL AS {'INTEGER' if kind == 'int' else 'VARCHAR'})" for n, kind in fields}

    def side(made: dict[str, str]) -> str:
        return f"SELECT {', '.join(f'{(nothing | made)[n]} AS {n}' for n, _ in fields)} FROM customer"
    union = f"{side(old)} UNION ALL {side(new)}"
    if not geo:
        return union
    names = ", ".join(n for n, _ in fields)
    return f"""WITH u AS ({union}), b AS ({_TERRITORY})
        SELECT {names}, {_region_columns()} FROM u LEFT JOIN b ON {_within('LONGITUDE', 'LATITUDE')}
        WHERE LONGITUDE IS NOT NULL AND LONGITUDE BETWEEN -180 AND 180 AND LATITUDE BETWEEN -90 AND 90"""


_BRANCHES = """SELECT CAST(s_suppkey AS VARCHAR) AS BranchCode, CAST(s_suppkey + 7 AS VARCHAR) AS OldBranchCode,
    s_name AS BranchDescEng, s_acctbal / 100.0::DOUBLE AS Longitude, (s_suppkey % 100) / 1.25::DOUBLE AS Latitude
    FROM supplier"""
_SHEET = """SELECT CAST(s_suppkey AS VARCHAR) AS Sheet,
    CASE WHEN s_nationkey <> 3 THEN CAST(s_nationkey AS VARCHAR) END AS Warehouse,
    CASE WHEN s_nationkey <> 3 THEN 'R' END AS RegionSale_Label, CAST(s_nationkey % 4 AS VARCHAR) AS League,
    s_nationkey % 2 AS PxIncludeFlag FROM supplier WHERE s_acctbal >= 0"""
_ROUTE_SHEET = """SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS YM,
    CAST(l_suppkey AS VARCHAR) AS Route, CAST(s_nationkey % 5 AS VARCHAR) AS TerritoryDistrict,
    CASE WHEN s_suppkey % 2 = 0 THEN 'PS' ELSE 'CS' END AS SalesType1, CAST(s_suppkey % 3 AS VARCHAR) AS SalesType2,
    CAST(s_nationkey AS VARCHAR) AS BranchVL, CAST(n_regionkey AS VARCHAR) AS RegionSSC, s_suppkey % 4 AS SubBranch,
    CAST(s_suppkey % 7 AS VARCHAR) AS SalesMan, CAST(s_suppkey % 10 AS VARCHAR) AS TDM,
    CAST(n_regionkey AS VARCHAR) AS DM
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey"""
_ROUTE_STAGE = """SELECT CAST(s_suppkey AS VARCHAR) AS Route, s_name AS RouteDesc,
    CAST(s_suppkey AS VARCHAR) || ' - ' || s_name AS RouteDescription, CAST(s_suppkey % 6 AS VARCHAR) AS Sector,
    '2001-08-01' AS ETLLoadData FROM supplier WHERE s_acctbal >= 0"""


def _routes_sql(stamp: str) -> str:
    return f"""WITH x AS ({_ROUTE_SHEET}), st AS ({_ROUTE_STAGE})
        SELECT DISTINCT x.Route, TerritoryDistrict, SalesType1, SalesType2, BranchVL, RegionSSC, SubBranch, RouteDesc,
            RouteDescription, Sector, {stamp} AS ETLLoadData
        FROM x LEFT JOIN st ON x.Route = st.Route WHERE YM = (SELECT max(YM) FROM x)"""


def _route_people_sql(stamp: str) -> str:
    return f"""WITH x AS ({_ROUTE_SHEET}), st AS ({_ROUTE_STAGE})
        SELECT DISTINCT x.Route, BranchVL, SalesMan, TDM, DM, YM, {stamp} AS ETLLoadData
        FROM x LEFT JOIN st ON x.Route = st.Route"""


def statements() -> dict[str, str]:
    volume_out = f"SELECT {_KEYS}, BasicMaterial, BrandDesc, Brand, MatType1, {doubles(_VOLUME_NAMES)} FROM g_volume"
    bills_out = f"SELECT {_KEYS}, NoOfBill, NoOfBillCN, NoOfBrand, NoOfBrandCN, {doubles(_BILL_NAMES)} FROM g_bills"
    brand_out = f"""SELECT {_KEYS}, BrandDescription, Brand, NoOfBrandBill, NoOfBrandBillCN, {doubles(_BILL_NAMES)}
        FROM g_brand"""
    window, full = brand_bills_view("200103"), brand_bills_view(None)
    deltas = {"NoOfBrandBill": "BIGINT", "SoldCase": "DOUBLE", "TotalAmount": "DOUBLE"}
    recon_sums = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in deltas)
    recon_out = ", ".join(
        f"CAST(coalesce(a.{m}, 0) - coalesce(b.{m}, 0) AS {kind}) AS {m}Delta" for m, kind in deltas.items())
    out = {
        "inv_vol_by_brand": with_views(volume_out, {"g_volume": volume_view("200103")}),
        "inv_vol_by_brand_full": with_views(volume_out, {"g_volume": volume_view(None)}),
        "inv_bill_brand": with_views(bills_out, {"g_bills": bills_view("200103")}),
        "inv_bill_brand_full": with_views(bills_out, {"g_bills": bills_view(None)}),
        "inv_bill_brand_text": with_views(bills_out, {"g_bills": bills_view(None, "")}),
        "inv_by_brand": with_views(brand_out, {"g_brand": window}),
        "inv_by_brand_full": with_views(brand_out, {"g_brand": full}),
        "mirror_inv_by_brand": with_views(brand_out, {"g_brand": window}),
        "visit_call": with_views(visits_view("200106")),
        "visit_call_full": with_views(visits_view(None)),
        "active_outlet": with_views(outlets_view("200108"), OUTLET_VIEWS),
        "active_outlet_full": with_views(outlets_view(None), OUTLET_VIEWS),
        "asset_count": with_views("""SELECT YM || '01' AS DateKey, BranchByVP AS BranchCode, VPRoute AS RouteCode,
            ActiveStatus, AssetStatus, AssetType, count(*) AS NoofCooler FROM f_asset_plan GROUP BY ALL"""),
        "asset_cooler": with_views(COOLER, {"g_volume": volume_view(None)}),
        "scorecard": scorecard_sql(False),
        "scorecard_parity": scorecard_sql(True),
        "invoice_slice": invoice_sql("WHERE ETLLoadData >= DATE '2001-08-01' - INTERVAL 5 DAY"),
        "invoice_load_full": invoice_sql(""),
        "visit_list_slice": _visit_sql("AssignedDate", "WHERE AssignedDate >= DATE '2001-07-31'"),
        "actual_visit_slice": _visit_sql("VisitDate", "WHERE VisitDate >= DATE '2001-07-31'"),
        "actual_visit_full": _visit_sql("VisitDate", f"WHERE strftime(VisitDate, '%Y%m') >= '{SINCE}'"),
        "asset_plan": _asset_sql(""),
        "asset_plan_slice": _asset_sql("WHERE ETLLoadData >= DATE '2001-07-31'"),
        "cust_plan": with_views("""SELECT YM, Branch, Route, Customer, CustomerTotal,
            CAST(FirstDay AS VARCHAR) AS FirstActiveBillingDate, YM AS FirstBillingMonth, 1 AS FirstBillingMonthCount,
            Customer AS SellToCustomer, CAST(FirstDay AS VARCHAR) AS ETLLoadData FROM f_plan """),
        "target_tdm": f"SELECT {_MANAGER} FROM ({_MANAGER_VIEW})",
        "target_ndtdm": f"""SELECT {_MANAGER} FROM ({_MANAGER_VIEW.replace(
            "JOIN orders ON l_orderkey = o_orderkey", "JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = 'O'")})""",
        "customer_union": _customer_sql(False),
        "customer_geo": _customer_sql(True),
        "location_geo": f"""WITH l AS ({_BRANCHES}), b AS ({_TERRITORY}), sh AS ({_SHEET})
            SELECT BranchCode, OldBranchCode, BranchDescEng, Longitude, Latitude, {_region_columns()},
                coalesce(Warehouse, '') AS Warehouse, '0' || coalesce(RegionSale_Label, '') AS RegionSale_Label, League,
                PxIncludeFlag
            FROM l LEFT JOIN b ON {_within('Longitude', 'Latitude')}
            LEFT JOIN sh ON sh.Sheet = BranchCode OR sh.Sheet = OldBranchCode""",
        "location_or_join": f"""WITH l AS ({_BRANCHES}), sh AS ({_SHEET})
            SELECT BranchCode, OldBranchCode, BranchDescEng, Longitude, Latitude, Warehouse, League
            FROM l LEFT JOIN sh ON sh.Sheet = BranchCode OR sh.Sheet = OldBranchCode""",
        "point_region": f"""WITH b AS ({_TERRITORY}), e AS (SELECT event_id, value, CAST(user_id AS DOUBLE) AS height
                FROM events)
            SELECT event_id, value, height, n_name AS t_name_t, CAST(n_regionkey AS VARCHAR) AS s_region
            FROM e LEFT JOIN b ON {_within('value', 'height')}""",
        "route_latest": _routes_sql("ETLLoadData"),
        "route_salesman": _route_people_sql("ETLLoadData"),
        # The mirrored column is a time.
        "mirror_route": f"SELECT * REPLACE (ETLLoadData || ' 00:00:00' AS ETLLoadData) FROM ({_routes_sql('ETLLoadData')})",
        "mirror_route_salesman": "SELECT * REPLACE (ETLLoadData || ' 00:00:00' AS ETLLoadData) FROM "
                                 f"({_route_people_sql('ETLLoadData')})",
        "salesman_merge": """WITH x AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, CASE WHEN s_nationkey <> 8 THEN s_name END
                AS d, CAST(s_suppkey AS VARCHAR) || ' - ' || CASE WHEN s_nationkey <> 8 THEN s_name END AS e
                FROM supplier WHERE s_acctbal < 6000),
            t AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, lower(s_name) AS d,
                CAST(s_suppkey AS VARCHAR) || ' / ' || lower(s_name) AS e FROM supplier WHERE s_acctbal >= 2000)
            SELECT coalesce(x.k, t.k) AS Salesman, coalesce(x.d, t.d) AS SalesmanDesc,
                coalesce(x.e, t.e) AS SalesmanDescription FROM x FULL JOIN t ON x.k = t.k""",
        "billing_calendar": """WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
            SELECT strftime(d, '%Y%m%d') AS DateKey, CAST(year(d) AS INTEGER) AS YearID,
                CAST(month(d) AS INTEGER) AS MonthID, CAST(day(d) AS INTEGER) AS DayID, CAST(d AS VARCHAR) AS DateRef,
                CASE WHEN dayofweek(d) <> 0 THEN 1 END AS WorkDayFlag FROM c""",
        "replace_month_window": _daily("DateKey >= '20010301'"),
        "replace_day_window": _daily("day >= DATE '2001-08-01' - INTERVAL 5 DAY"),
        "replace_keys_join": _replaced(_BRANCH, ["YM"]),
        "replace_keys_exists": _replaced(_ROUTE, ["YM"]),
        "replace_keys_derived": f"""WITH m AS ({_MANAGER_VIEW}) SELECT {_MANAGER} FROM m WHERE Brand <> 'R'
            AND YM NOT IN (SELECT YM FROM m WHERE Brand = 'R') UNION ALL SELECT {_MANAGER} FROM m WHERE Brand = 'R'""",
        "recon_delta": with_views(f"""
            SELECT DateKey, BranchCode, {recon_out}, coalesce(a.n, 0) AS LeftRows, coalesce(b.n, 0) AS RightRows,
                CASE WHEN a.n IS NOT NULL AND b.n IS NOT NULL THEN 'both' WHEN a.n IS NOT NULL THEN 'left_only'
                     ELSE 'right_only' END AS Presence
            FROM (SELECT DateKey, BranchCode, count(*) AS n, {recon_sums} FROM g_window GROUP BY 1, 2) a
            FULL JOIN (SELECT DateKey, BranchCode, count(*) AS n, {recon_sums} FROM g_brand GROUP BY 1, 2) b
                USING (DateKey, BranchCode)
            WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
               OR {" OR ".join(f"coalesce(a.{m}, 0) <> coalesce(b.{m}, 0)" for m in deltas)}""",
            {"g_window": window, "g_brand": full}),
    }
    out["recon_drill"] = out["recon_delta"]
    for name, view in (("target_branch", _targets_view()), ("target_branch_dm", _targets_view(priority="1-URGENT")),
                       ("target_branch_nddm", _targets_view(priority="5-LOW"))):
        out[name] = f"SELECT {_BRANCH} FROM ({view})"
    for name, view in (("target_route", _targets_view()), ("target_route_nd", _targets_view("F"))):
        out[name] = f"SELECT {_ROUTE} FROM ({view})"
    for name, table in (COPIES | MIRRORED).items():
        out[name] = _filled_sql(table)
    return out
