"""SQL for the silver and gold jobs.

The input derivations, merge keys and check texts are shared with the jobs,
as they are given data. Deduplication, fills, joins and key assignment are
written out here on their own.
"""

import re

from granary.queries.layers import CONTENT
from granary.queries.storefront import FEED_SQL
from granary.registry import SOURCES, WAREHOUSE, source
from granary.registry.base import widen_ids

AS_OF = "timestamp '2002-01-01 00:00:00'"

PERIODS = """(SELECT 1 v, timestamp '1995-01-01 00:00:00' sd, timestamp '1997-05-29 00:00:00' ed,
    cast(0.8 AS decimal(4,2)) f
  UNION ALL SELECT 2, timestamp '1997-05-30 00:00:00', timestamp '1999-05-29 00:00:00', cast(0.9 AS decimal(4,2))
  UNION ALL SELECT 3, timestamp '1999-05-30 00:00:00', cast(NULL AS timestamp), cast(1.0 AS decimal(4,2)))"""
HISTORY = """SELECT p_partkey AS ProductID, sd AS StartDate,
    CASE WHEN v = 1 AND p_partkey % 41 = 2 THEN timestamp '1994-01-01 00:00:00' ELSE ed END AS EndDate,
    cast(CASE WHEN v = 1 AND p_partkey % 41 = 1 THEN cast(-1 AS decimal(19,4))
      ELSE cast(cast(p_retailprice AS decimal(19,4)) * f AS decimal(19,4)) END{factor} AS decimal(19,4)) AS {amount},
    timestamp '2001-01-01 00:00:00' AS ModifiedDate
  FROM part CROSS JOIN {periods} z WHERE p_size >= 6 {condition}"""

FEEDS = {name: re.sub(r"\{(\w+)\}", r"\1", sql) for name, sql in FEED_SQL.items()} | {
    "Production_ProductCostHistory": HISTORY.format(
        factor="", amount="StandardCost", periods=PERIODS, condition=""
    ),
    "Production_ProductListPriceHistory": HISTORY.format(
        factor=" * 2", amount="ListPrice", periods=PERIODS, condition="AND v <> 2"
    ),
}

# Fills and clean-up per table, beside the shared ones.
OWN_FILLS = {
    "Sales_SalesOrderHeader": {
        "RevisionNumber": "coalesce(RevisionNumber, 0)",
        "SubTotal": "coalesce(SubTotal, 0)",
        "TaxAmt": "coalesce(TaxAmt, 0)",
        "Freight": "coalesce(Freight, 0)",
        "Status": "coalesce(Status, 1)",
        "OnlineOrderFlag": "coalesce(OnlineOrderFlag, true)",
        "OrderDate": f"coalesce(OrderDate, {AS_OF})",
    },
    "Sales_SalesOrderDetail": {
        "UnitPriceDiscount": "coalesce(UnitPriceDiscount, 0)",
        "LineTotal": "CASE WHEN UnitPrice * (1.0 - coalesce(UnitPriceDiscount, 0)) * OrderQty IS NULL "
        "THEN 0 ELSE LineTotal END",
    },
    "Sales_Customer": {
        "AccountNumber": "coalesce(AccountNumber, "
        "concat('AW', right(concat('00000000', cast(CustomerID AS varchar)), 8)))",
    },
    "Sales_SpecialOffer": {"DiscountPct": "coalesce(DiscountPct, 0)", "MinQty": "coalesce(MinQty, 0)"},
    "Sales_SalesTerritory": {
        "SalesYTD": "coalesce(SalesYTD, 0)",
        "SalesLastYear": "coalesce(SalesLastYear, 0)",
        "CostYTD": "coalesce(CostYTD, 0)",
        "CostLastYear": "coalesce(CostLastYear, 0)",
    },
    "Person_StateProvince": {"IsOnlyStateProvinceFlag": "coalesce(IsOnlyStateProvinceFlag, true)"},
    "Person_Person": {
        "NameStyle": "coalesce(NameStyle, false)",
        "EmailPromotion": "coalesce(EmailPromotion, 0)",
    },
    "Production_Product": {
        "MakeFlag": "coalesce(MakeFlag, true)",
        "FinishedGoodsFlag": "coalesce(FinishedGoodsFlag, true)",
        "Class": "trim(Class)",
        "Style": "trim(Style)",
        "ProductLine": "trim(ProductLine)",
    },
}
NO_ROW_ID_FILL = {"Production_ProductModel"}


def columns_of(ddl: str) -> list[tuple[str, str]]:
    """Column names and types of a DDL text, keys as BIGINT."""
    return re.findall(r"`?(\w+)`? ([A-Z]+(?:\(\d+,\d+\))?)(?: NOT NULL)?(?:,|$)", widen_ids(ddl))


def uuid_text(label: str, keys: tuple[str, ...]) -> str:
    sized = [f"coalesce(length(cast({k} AS varchar)) || ':' || cast({k} AS varchar), '-')" for k in keys]
    text = " || ".join([f"'{label}|'", *sized])
    groups = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return f"regexp_replace(md5({text}), '{groups}', '\\1-\\2-\\3-\\4-\\5')"


def filled(name: str, feeds: dict[str, str] = FEEDS) -> str:
    """Latest row per key with all fills, before the checks."""
    spec = SOURCES[name]
    columns = [c for c, _ in columns_of(spec.ddl)]
    order = "_process_timestamp" if "ModifiedDate" not in columns else "ModifiedDate"
    rest = [
        c
        for c in columns
        if c not in spec.keys and c != order and c not in ("_process_timestamp", "_input_file_name")
    ]
    ranking = ", ".join(f'"{c}" DESC NULLS LAST' for c in (order, *rest))
    replaced = dict(OWN_FILLS.get(name, {}))
    replaced["_process_timestamp"] = f"coalesce(_process_timestamp, {AS_OF})"
    if "ModifiedDate" in columns:
        replaced["ModifiedDate"] = f"coalesce(ModifiedDate, {AS_OF})"
    if "rowguid" in columns and name not in NO_ROW_ID_FILL:
        replaced["rowguid"] = f"coalesce(rowguid, {uuid_text(name, spec.keys)})"
    replaces = ", ".join(f'{sql} AS "{c}"' for c, sql in replaced.items())
    return f"""SELECT * REPLACE ({replaces}) FROM (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {", ".join(spec.keys)} ORDER BY {ranking}) rn
        FROM (SELECT *, cast(NULL AS timestamp) AS _process_timestamp,
          'landing/{name}' AS _input_file_name FROM ({feeds[name]}) raw) feed) ranked
      WHERE rn = 1) latest"""


def silver(name: str, feeds: dict[str, str] = FEEDS) -> str:
    spec = SOURCES[name]
    types = {"STRING": "VARCHAR"}
    casts = ", ".join(f'cast("{c}" AS {types.get(t, t)}) AS "{c}"' for c, t in columns_of(spec.ddl))
    passes = " AND ".join(f"({sql})" for sql in spec.checks.values()) or "true"
    return f"SELECT {casts} FROM ({filled(name, feeds)}) f WHERE {passes}"


def quarantine(name: str) -> str:
    spec = SOURCES[name]
    passes = " AND ".join(f"({sql})" for sql in spec.checks.values())
    failed = ", ".join(
        f"CASE WHEN coalesce({sql}, false) THEN NULL ELSE '{check}' END"
        for check, sql in spec.checks.items()
    )
    types = {"STRING": "VARCHAR"}
    casts = ", ".join(f'cast("{c}" AS {types.get(t, t)}) AS "{c}"' for c, t in columns_of(spec.ddl))
    return (
        f"SELECT {casts}, concat_ws(',', {failed}) AS failed FROM ({filled(name)}) f "
        f"WHERE coalesce({passes}, false) = false"
    )


def with_silver(names: tuple[str, ...], query: str, feeds: dict[str, str] = FEEDS) -> str:
    tables = []
    for n in names:
        # "Customer" and "customer" are one name in SQL, so silver tables get a prefix.
        query = query.replace(f'"{n}"', f"silver_{n}")
        tables.append(f"silver_{n} AS MATERIALIZED ({silver(source(n).full_name, feeds)})")
    return f"WITH {', '.join(tables)} {query}"


DIM_CURRENCY = """SELECT row_number() OVER (ORDER BY CurrencyCode) AS CurrencyKey,
  CurrencyCode AS CurrencyAlternateKey, Name AS CurrencyName FROM "Currency" """

DIM_REASON = """SELECT row_number() OVER (ORDER BY SalesReasonID) AS SalesReasonKey,
  SalesReasonID AS SalesReasonAlternateKey, Name AS SalesReasonName, ReasonType AS SalesReasonReasonType
FROM "SalesReason" """

DIM_PROMOTION = """SELECT row_number() OVER (ORDER BY SpecialOfferID) AS PromotionKey,
  SpecialOfferID AS PromotionAlternateKey, Description AS EnglishPromotionName,
  cast(NULL AS varchar) AS SpanishPromotionName, cast(NULL AS varchar) AS FrenchPromotionName,
  cast(DiscountPct AS float) AS DiscountPct, Type AS EnglishPromotionType,
  cast(NULL AS varchar) AS SpanishPromotionType, cast(NULL AS varchar) AS FrenchPromotionType,
  Category AS EnglishPromotionCategory, cast(NULL AS varchar) AS SpanishPromotionCategory,
  cast(NULL AS varchar) AS FrenchPromotionCategory, StartDate, EndDate, MinQty, MaxQty
FROM "SpecialOffer" """

DIM_TERRITORY = """SELECT row_number() OVER (ORDER BY TerritoryID) AS SalesTerritoryKey,
  TerritoryID AS SalesTerritoryAlternateKey, t.Name AS SalesTerritoryRegion,
  c.Name AS SalesTerritoryCountry, t."Group" AS SalesTerritoryGroup, cast(NULL AS blob) AS SalesTerritoryImage
FROM "SalesTerritory" t LEFT JOIN "CountryRegion" c ON t.CountryRegionCode = c.CountryRegionCode"""

DIM_CUSTOMER = """SELECT c.CustomerID AS CustomerKey, cast(NULL AS bigint) AS GeographyKey,
  c.AccountNumber AS CustomerAlternateKey, p.Title, p.FirstName, p.MiddleName, p.LastName, p.NameStyle,
  cast(d.BirthDate AS date) AS BirthDate, d.MaritalStatus, p.Suffix, d.Gender, e.EmailAddress,
  d.YearlyIncome, cast(d.TotalChildren AS tinyint) AS TotalChildren,
  cast(d.NumberChildrenAtHome AS tinyint) AS NumberChildrenAtHome, d.Education AS EnglishEducation,
  cast(NULL AS varchar) AS SpanishEducation, cast(NULL AS varchar) AS FrenchEducation,
  d.Occupation AS EnglishOccupation, cast(NULL AS varchar) AS SpanishOccupation,
  cast(NULL AS varchar) AS FrenchOccupation, cast(d.HomeOwnerFlag AS varchar) AS HouseOwnerFlag,
  cast(d.NumberCarsOwned AS tinyint) AS NumberCarsOwned, a.AddressLine1, a.AddressLine2,
  ph.PhoneNumber AS Phone, cast(d.DateFirstPurchase AS date) AS DateFirstPurchase,
  cast(NULL AS varchar) AS CommuteDistance
FROM "Customer" c LEFT JOIN "Person" p ON c.PersonID = p.BusinessEntityID
LEFT JOIN "PersonPhone" ph ON c.PersonID = ph.BusinessEntityID
LEFT JOIN "EmailAddress" e ON c.PersonID = e.BusinessEntityID
LEFT JOIN "BusinessEntityAddress" b ON c.PersonID = b.BusinessEntityID
LEFT JOIN "Address" a ON b.AddressID = a.AddressID
LEFT JOIN "vPersonDemographics" d ON c.PersonID = d.BusinessEntityID"""

TEXT = "min_by(Description, b.ProductDescriptionID) FILTER (WHERE trim(CultureID) = '{}') AS {}"
DIM_PRODUCT = f"""SELECT
  row_number() OVER (ORDER BY p.ProductNumber, h.StartDate NULLS FIRST) AS ProductKey,
  p.ProductNumber AS ProductAlternateKey, p.ProductSubcategoryID AS ProductSubcategoryKey,
  p.WeightUnitMeasureCode, p.SizeUnitMeasureCode, p.Name AS EnglishProductName,
  cast(NULL AS varchar) AS SpanishProductName, cast(NULL AS varchar) AS FrenchProductName,
  h.StandardCost, p.FinishedGoodsFlag, p.Color, p.SafetyStockLevel, p.ReorderPoint, h.ListPrice, p.Size,
  cast(NULL AS varchar) AS SizeRange, cast(p.Weight AS float) AS Weight, p.DaysToManufacture, p.ProductLine,
  cast(NULL AS decimal(19,4)) AS DealerPrice, p.Class, p.Style, m.Name AS ModelName,
  cast(NULL AS blob) AS LargePhoto, md5(t.en) AS EnglishDescription, md5(t.fr) AS FrenchDescription,
  md5(t.zh) AS ChineseDescription, md5(t.ar) AS ArabicDescription, md5(t.he) AS HebrewDescription,
  md5(t.th) AS ThaiDescription, cast(NULL AS varchar) AS GermanDescription,
  cast(NULL AS varchar) AS JapaneseDescription, cast(NULL AS varchar) AS TurkishDescription,
  h.StartDate, h.EndDate, CASE WHEN h.EndDate IS NULL THEN 'Current' END AS Status
FROM "Product" p LEFT JOIN "ProductModel" m ON p.ProductModelID = m.ProductModelID
LEFT JOIN (SELECT c.ProductID, c.StartDate, c.EndDate, c.StandardCost, l.ListPrice
  FROM "ProductCostHistory" c LEFT JOIN "ProductListPriceHistory" l ON c.ProductID = l.ProductID
    AND c.StartDate = l.StartDate AND c.EndDate IS NOT DISTINCT FROM l.EndDate) h ON p.ProductID = h.ProductID
LEFT JOIN (SELECT b.ProductModelID, {TEXT.format("en", "en")}, {TEXT.format("fr", "fr")},
    {TEXT.format("zh-cht", "zh")}, {TEXT.format("ar", "ar")}, {TEXT.format("he", "he")},
    {TEXT.format("th", "th")}
  FROM "ProductModelProductDescriptionCulture" b
  LEFT JOIN "ProductDescription" x ON b.ProductDescriptionID = x.ProductDescriptionID
  GROUP BY b.ProductModelID) t ON p.ProductModelID = t.ProductModelID"""

DIMENSIONS = {
    "DimProduct": DIM_PRODUCT,
    "DimCurrency": DIM_CURRENCY,
    "DimPromotion": DIM_PROMOTION,
    "DimCustomer": DIM_CUSTOMER,
    "DimSalesTerritory": DIM_TERRITORY,
    "DimSalesReason": DIM_REASON,
}

FACT = f"""SELECT dp.ProductKey, cast(strftime(h.OrderDate, '%Y%m%d') AS int) AS OrderDateKey,
  cast(strftime(h.DueDate, '%Y%m%d') AS int) AS DueDateKey,
  cast(strftime(h.ShipDate, '%Y%m%d') AS int) AS ShipDateKey, h.CustomerID AS CustomerKey,
  pr.PromotionKey, cu.CurrencyKey, te.SalesTerritoryKey, h.SalesOrderNumber,
  cast(row_number() OVER (PARTITION BY h.SalesOrderNumber
    ORDER BY l.SalesOrderID, l.SalesOrderDetailID, dp.ProductKey) AS tinyint) AS SalesOrderLineNumber,
  h.RevisionNumber, l.OrderQty AS OrderQuantity, l.UnitPrice, l.LineTotal AS ExtendedAmount,
  cast(l.UnitPriceDiscount AS float) AS UnitPriceDiscountPct,
  cast(l.UnitPriceDiscount * l.UnitPrice AS float) AS DiscountAmount,
  dp.StandardCost AS ProductStandardCost,
  cast(l.OrderQty * dp.StandardCost AS decimal(19,4)) AS TotalProductCost,
  cast(l.LineTotal - l.UnitPriceDiscount * l.UnitPrice AS decimal(19,4)) AS SalesAmount,
  h.TaxAmt, h.Freight, l.CarrierTrackingNumber, h.PurchaseOrderNumber AS CustomerPONumber,
  h.OrderDate, h.DueDate, h.ShipDate
FROM "SalesOrderDetail" l JOIN "SalesOrderHeader" h ON l.SalesOrderID = h.SalesOrderID AND h.OnlineOrderFlag
LEFT JOIN "Product" p ON l.ProductID = p.ProductID
LEFT JOIN ({DIM_PRODUCT}) dp ON p.ProductNumber = dp.ProductAlternateKey
  AND h.OrderDate BETWEEN dp.StartDate AND coalesce(dp.EndDate, {AS_OF})
LEFT JOIN ({DIM_PROMOTION}) pr ON l.SpecialOfferID = pr.PromotionAlternateKey
LEFT JOIN ({DIM_TERRITORY}) te ON h.TerritoryID = te.SalesTerritoryAlternateKey
LEFT JOIN "SalesTerritory" st ON h.TerritoryID = st.TerritoryID
LEFT JOIN (SELECT CountryRegionCode, min(CurrencyCode) AS CurrencyCode FROM "CountryRegionCurrency"
  GROUP BY 1) cc ON st.CountryRegionCode = cc.CountryRegionCode
LEFT JOIN ({DIM_CURRENCY}) cu ON cc.CurrencyCode = cu.CurrencyAlternateKey"""

FACT_SOURCES = tuple(
    dict.fromkeys(
        (
            "SalesOrderDetail",
            "SalesOrderHeader",
            "CountryRegionCurrency",
            *WAREHOUSE["DimProduct"].sources,
            *WAREHOUSE["DimPromotion"].sources,
            *WAREHOUSE["DimSalesTerritory"].sources,
            *WAREHOUSE["DimCurrency"].sources,
        )
    )
)

REASONS = f"""SELECT f.SalesOrderNumber, f.SalesOrderLineNumber, r.SalesReasonID AS SalesReasonKey
FROM ({FACT}) f JOIN "SalesOrderHeaderSalesReason" r
  ON r.SalesOrderID = cast(substring(f.SalesOrderNumber, 3) AS bigint)"""


def snake(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"([A-Z])", r"_\1", name).lower()).strip("_")


LAYER_ORACLES = {
    **{f"silver_{snake(n)}": silver(n) for n in SOURCES},
    **{f"quarantine_{snake(n)}": quarantine(n) for n, t in SOURCES.items() if t.checks},
    **{f"gold_{snake(n)}": with_silver(WAREHOUSE[n].sources, sql) for n, sql in DIMENSIONS.items()},
    "gold_fact_internet_sales": with_silver(FACT_SOURCES, FACT),
    "gold_fact_internet_sales_reason": with_silver((*FACT_SOURCES, "SalesOrderHeaderSalesReason"), REASONS),
}

# A second load of the same data updates every row and changes none.
RERUN_COUNTS = {n: LAYER_ORACLES[f"gold_{snake(n)}"] for n in WAREHOUSE if n != "DimDate"} | {
    "DimDate": "SELECT unnest(generate_series(date '2005-01-01', date '2014-12-31', interval 1 day)) d"
}
LAYER_ORACLES["load_twice"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, 0 AS inserted, (SELECT count(*) FROM ({sql}) g) AS updated, "
    "0 AS deleted, 0 AS changed_rows"
    for n, sql in RERUN_COUNTS.items()
)



def check_counts(name: str) -> str:
    """What each check of a table has found."""
    names = ", ".join(f"'{c}'" for c in SOURCES[name].checks)
    return f"""SELECT '{name}' AS table_name, c AS check_name,
      (SELECT count(*) FROM {name}_held q WHERE list_contains(string_split(failed, ','), c)) AS failed,
      (SELECT count(*) FROM {name}_held) + (SELECT count(*) FROM {name}_kept) AS checked,
      (SELECT count(*) FROM {name}_kept) AS accepted, (SELECT count(*) FROM {name}_held) AS quarantined
    FROM (SELECT unnest([{names}]) AS c) checks"""


CHECKED_TABLES = [n for n, t in SOURCES.items() if t.checks]
LAYER_ORACLES["load_checks"] = (
    "WITH "
    + ", ".join(
        f"{n}_held AS MATERIALIZED ({quarantine(n)}), {n}_kept AS MATERIALIZED ({silver(n)})" for n in CHECKED_TABLES
    )
    + " "
    + " UNION ALL ".join(check_counts(n) for n in CHECKED_TABLES)
)

# The source some time later.
LATER = "timestamp '2001-02-01 00:00:00'"
CHANGED = FEEDS | {
    name: sql.format(feed=FEEDS[name])
    for name, sql in {
        "Sales_Currency": "SELECT * FROM ({feed}) f WHERE CurrencyCode <> 'AFR' "
        f"UNION ALL SELECT 'XXX', 'Extra unit', {LATER}",
        "Sales_SalesReason": "SELECT * FROM ({feed}) f WHERE SalesReasonID <> 4 "
        f"UNION ALL SELECT 9, 'New', 'Other', {LATER}",
        "Sales_SpecialOffer": "SELECT * REPLACE (CASE WHEN SpecialOfferID = 5 THEN Description || '!' "
        "ELSE Description END AS Description) FROM ({feed}) f WHERE SpecialOfferID <> 3",
        "Sales_Customer": "SELECT * REPLACE (CASE WHEN CustomerID % 50 = 1 THEN 'CHANGED' "
        "ELSE AccountNumber END AS AccountNumber) FROM ({feed}) f WHERE CustomerID % 50 <> 0",
        "Production_Product": "SELECT * REPLACE (CASE WHEN ProductID % 40 = 5 THEN 'zzz' ELSE Color END "
        "AS Color) FROM ({feed}) f WHERE ProductID % 40 <> 3",
        "Sales_SalesOrderHeader": "SELECT * FROM ({feed}) f WHERE SalesOrderID % 30 <> 0",
    }.items()
}


def gold(name: str, feeds: dict[str, str]) -> str:
    if name == "DimDate":
        return f"SELECT cast(strftime(d, '%Y%m%d') AS int) AS DateKey FROM ({RERUN_COUNTS[name]}) days"
    if name in DIMENSIONS:
        return with_silver(WAREHOUSE[name].sources, DIMENSIONS[name], feeds)
    if name == "FactInternetSales":
        return with_silver(FACT_SOURCES, FACT, feeds)
    return with_silver((*FACT_SOURCES, "SalesOrderHeaderSalesReason"), REASONS, feeds)


def change_report(name: str) -> str:
    """Merge counts and content of a gold table after the change; new keys follow the highest old one."""
    spec = WAREHOUSE[name]
    same = " AND ".join(
        f'a."{k}" IS NOT DISTINCT FROM b."{k}"' if spec.null_safe_keys else f'a."{k}" = b."{k}"' for k in spec.keys
    )
    columns = list(CONTENT[name])
    if spec.identity:
        columns.remove(spec.identity)
        order = ", ".join(f'b."{k}" NULLS FIRST' for k in spec.keys)
        key = (
            f'coalesce(a."{spec.identity}", (SELECT max("{spec.identity}") FROM a) '
            f'+ row_number() OVER (PARTITION BY a."{spec.identity}" IS NULL ORDER BY {order}))'
        )
        parts = [key, *[f'b."{c}"' for c in columns]]
    else:
        parts = [f'b."{c}"' for c in columns]
    text = ", ".join(f"coalesce(cast({p} AS varchar), '~')" for p in parts)
    return f"""SELECT '{name}' AS table_name,
      (SELECT count(*) FROM b ANTI JOIN a ON {same}) AS inserted,
      (SELECT count(*) FROM b SEMI JOIN a ON {same}) AS updated,
      (SELECT count(*) FROM a ANTI JOIN b ON {same}) AS deleted,
      (SELECT count(*) FROM b) AS n_rows,
      (SELECT cast(coalesce(sum(cast('0x' || substring(md5(line), 1, 8) AS bigint)), 0) AS bigint)
        FROM (SELECT concat_ws('|', {text}) AS line FROM b LEFT JOIN a ON {same}) lines) AS content
    FROM (SELECT 1) one"""


LAYER_ORACLES["load_changed"] = " UNION ALL ".join(
    f"SELECT * FROM (WITH a AS MATERIALIZED ({gold(n, FEEDS)}), b AS MATERIALIZED ({gold(n, CHANGED)}) "
    f"{change_report(n)}) report_{snake(n)}"
    for n in WAREHOUSE
)
LAYER_ORACLES["load_stored_check"] = f"""
SELECT CustomerID, concat_ws(',', CASE WHEN PersonID IS NULL THEN 'CK_Customer_PersonID' END,
  CASE WHEN CustomerID % 7 = 0 THEN 'own_number' END) AS failed
FROM ({filled("Sales_Customer")}) f"""
