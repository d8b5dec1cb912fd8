"""Operational tables derived from the order, part and customer tables at hand.

The pipeline's own source system is not part of this repository. These
queries reshape TPC-H-like tables into the 26 operational tables, with the
flaws the silver jobs deal with: repeated keys, missing values, padded text
and values that fail a check. Every derivation reads its whole input table.

The SQL sticks to what Spark and other ANSI engines share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.sales import MONEY
from granary.operators.dedup import keep_latest
from granary.registry import SOURCES

LOADED, LONG_AGO = "2001-01-01 00:00:00", "1994-01-01 00:00:00"

# Product versions: valid from, valid to, share of the retail price.
VERSIONS = (
    (1, "1995-01-01 00:00:00", "1997-05-29 00:00:00", "0.80"),
    (2, "1997-05-30 00:00:00", "1999-05-29 00:00:00", "0.90"),
    (3, "1999-05-30 00:00:00", None, "1.00"),
)
# Parts below this size have no history.
FIRST_SIZE_WITH_HISTORY = 6

FEED_SQL = {
    "Sales_SalesOrderHeader": """
        SELECT o_orderkey AS SalesOrderID,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 1 END AS RevisionNumber,
          CASE WHEN o_totalprice < 5000 THEN NULL ELSE cast(o_orderdate AS timestamp) END AS OrderDate,
          cast(o_orderdate + interval '12' day AS timestamp) AS DueDate,
          CASE WHEN o_orderstatus = 'O' THEN NULL
               WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 450000
                 THEN cast(o_orderdate - interval '1' day AS timestamp)
               ELSE cast(o_orderdate + interval '7' day AS timestamp) END AS ShipDate,
          CASE WHEN o_orderkey % 97 = 3 THEN 9 WHEN o_orderstatus = 'F' THEN 5
               WHEN o_orderstatus = 'O' THEN 1 ELSE NULL END AS Status,
          CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false ELSE NULL END AS OnlineOrderFlag,
          concat('SO', cast(o_orderkey AS varchar(30))) AS SalesOrderNumber,
          concat('PO', cast(o_custkey AS varchar(30))) AS PurchaseOrderNumber,
          cast(NULL AS varchar(30)) AS AccountNumber,
          o_custkey AS CustomerID, cast(NULL AS int) AS SalesPersonID,
          cast(o_custkey % 25 AS int) AS TerritoryID,
          o_custkey AS BillToAddressID, o_custkey AS ShipToAddressID, 5 AS ShipMethodID,
          cast(NULL AS int) AS CreditCardID, cast(NULL AS varchar(30)) AS CreditCardApprovalCode,
          cast(NULL AS int) AS CurrencyRateID,
          CASE WHEN o_orderkey % 97 = 5 THEN cast(-1 AS decimal(19,4))
               ELSE cast(o_totalprice AS decimal(19,4)) END AS SubTotal,
          CASE WHEN o_orderkey % 97 = 7 THEN cast(-1 AS decimal(19,4))
               WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE cast(8.25 AS decimal(19,4)) END AS TaxAmt,
          CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice > 400000
               THEN cast(-1 AS decimal(19,4)) ELSE cast(25 AS decimal(19,4)) END AS Freight,
          cast(o_totalprice AS decimal(19,4)) AS TotalDue,
          cast(NULL AS varchar(30)) AS Comment,
          CASE WHEN o_orderstatus = 'F' THEN NULL
               ELSE concat('header-', cast(o_orderkey AS varchar(30))) END AS rowguid,
          cast(o_orderdate AS timestamp) AS ModifiedDate
        FROM {orders}""",
    "Sales_SalesOrderDetail": """
        SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID,
          concat(l_returnflag, l_linestatus) AS CarrierTrackingNumber,
          CASE WHEN l_returnflag = 'R' AND l_tax > 0.07 THEN -l_quantity ELSE l_quantity END AS OrderQty,
          l_partkey AS ProductID,
          cast(round(l_discount * 100) AS int) AS SpecialOfferID,
          CASE WHEN l_tax > 0.075 THEN NULL ELSE cast(l_extendedprice AS decimal(19,4)) END AS UnitPrice,
          CASE WHEN l_orderkey % 97 = 11 THEN cast(-0.01 AS decimal(19,4))
               WHEN l_discount = 0 THEN NULL ELSE cast(l_discount AS decimal(19,4)) END
            AS UnitPriceDiscount,
          cast(l_extendedprice AS decimal(19,4)) AS LineTotal,
          CASE WHEN l_linenumber = 7 THEN NULL
               ELSE concat('line-', cast(l_linenumber AS varchar(30))) END AS rowguid,
          cast(l_shipdate AS timestamp) AS ModifiedDate
        FROM {lineitem}""",
    "Sales_Customer": """
        SELECT c_custkey AS CustomerID,
          CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 1000 THEN NULL ELSE c_custkey END AS PersonID,
          cast(NULL AS int) AS StoreID, c_nationkey AS TerritoryID,
          CASE WHEN c_acctbal < 5000 THEN NULL
               ELSE concat('AC', cast(c_custkey AS varchar(30))) END AS AccountNumber,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {customer}""",
    "Sales_SpecialOffer": """
        SELECT cast(round(l_discount * 100) AS int) AS SpecialOfferID,
          concat('Discount ', cast(cast(round(l_discount * 100) AS int) AS varchar(30))) AS Description,
          CASE WHEN l_discount = 0 THEN NULL WHEN round(l_discount * 100) = 9 THEN cast(-0.09 AS decimal(10,4))
               ELSE cast(l_discount AS decimal(10,4)) END AS DiscountPct,
          CASE WHEN l_discount > 0.05 THEN 'Volume' ELSE 'Seasonal' END AS Type,
          'Reseller' AS Category,
          timestamp '1995-01-01 00:00:00' AS StartDate,
          CASE WHEN l_discount > 0.095 THEN timestamp '1994-01-01 00:00:00'
               ELSE timestamp '2001-12-31 00:00:00' END AS EndDate,
          CASE WHEN round(l_discount * 100) = 7 THEN -1 WHEN l_discount > 0.05 THEN 10 ELSE NULL END AS MinQty,
          CASE WHEN round(l_discount * 100) = 8 THEN -1 ELSE NULL END AS MaxQty,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT l_discount FROM {lineitem}) offers""",
    "Sales_Currency": """
        SELECT substring(r_name, 1, 3) AS CurrencyCode, concat(r_name, ' unit') AS Name,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {region}""",
    "Sales_SalesTerritory": """
        SELECT n_nationkey AS TerritoryID, n_name AS Name,
          substring(r_name, 1, 2) AS CountryRegionCode, r_name AS "Group",
          cast(n_nationkey - 1 AS decimal(19,4)) AS SalesYTD,
          CASE WHEN n_nationkey = 24 THEN cast(-1 AS decimal(19,4)) ELSE NULL END AS SalesLastYear,
          CASE WHEN n_nationkey = 23 THEN cast(-1 AS decimal(19,4)) ELSE NULL END AS CostYTD,
          cast(CASE WHEN n_nationkey = 22 THEN -1 ELSE 0 END AS decimal(19,4)) AS CostLastYear,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "Sales_SalesReason": """
        SELECT cast(substring(o_orderpriority, 1, 1) AS int) AS SalesReasonID,
          substring(o_orderpriority, 3) AS Name,
          CASE WHEN o_orderpriority < '3' THEN 'Promotion' ELSE 'Other' END AS ReasonType,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT o_orderpriority FROM {orders}) reasons""",
    "Sales_vPersonDemographics": """
        SELECT CASE WHEN c_custkey % 31 = 1 THEN NULL ELSE c_custkey END AS BusinessEntityID,
          CASE WHEN c_custkey % 31 = 2 THEN NULL ELSE cast(c_acctbal AS decimal(19,4)) END AS TotalPurchaseYTD,
          CASE WHEN c_custkey % 31 = 3 THEN NULL ELSE timestamp '1999-06-01 00:00:00' END AS DateFirstPurchase,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE timestamp '1970-02-03 00:00:00' END AS BirthDate,
          CASE WHEN c_custkey % 31 = 4 THEN NULL WHEN c_nationkey < 12 THEN 'M' ELSE 'S' END AS MaritalStatus,
          CASE WHEN c_custkey % 31 = 5 THEN NULL WHEN c_acctbal > 5000 THEN 'greater than 100000'
               ELSE '0-25000' END AS YearlyIncome,
          CASE WHEN c_custkey % 31 = 6 THEN NULL WHEN c_nationkey < 10 THEN 'F' ELSE 'M' END AS Gender,
          CASE WHEN c_custkey % 31 = 7 THEN NULL ELSE c_nationkey END AS TotalChildren,
          CASE WHEN c_custkey % 31 = 8 THEN NULL ELSE 0 END AS NumberChildrenAtHome,
          CASE WHEN c_custkey % 31 = 9 THEN NULL ELSE 'Bachelors' END AS Education,
          CASE WHEN c_custkey % 31 = 10 THEN NULL ELSE lower(c_mktsegment) END AS Occupation,
          CASE WHEN c_custkey % 31 = 11 THEN NULL ELSE c_acctbal > 2500 END AS HomeOwnerFlag,
          CASE WHEN c_custkey % 31 = 12 THEN NULL ELSE 2 END AS NumberCarsOwned
        FROM {customer}""",
    "Sales_CountryRegionCurrency": """
        SELECT substring(r_name, 1, 2) AS CountryRegionCode, substring(r_name, 1, 3) AS CurrencyCode,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {region}
        UNION ALL
        SELECT substring(r_name, 1, 2), 'ASI', timestamp '2001-01-01 00:00:00'
        FROM {region} WHERE r_name > 'ASIB'""",
    "Sales_SalesOrderHeaderSalesReason": """
        SELECT o_orderkey AS SalesOrderID, cast(substring(o_orderpriority, 1, 1) AS int) AS SalesReasonID,
          cast(o_orderdate AS timestamp) AS ModifiedDate
        FROM {orders} WHERE o_orderpriority < '4'""",
    "Person_Address": """
        SELECT c_custkey AS AddressID, concat(c_name, ' street') AS AddressLine1,
          CASE WHEN c_nationkey < 5 THEN 'Floor 2' ELSE NULL END AS AddressLine2,
          lower(c_mktsegment) AS City, c_nationkey AS StateProvinceID,
          cast(10000 + c_custkey AS varchar(30)) AS PostalCode, 'POINT (0 0)' AS SpatialLocation,
          cast(NULL AS varchar(30)) AS rowguid,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE timestamp '2001-01-01 00:00:00' END AS ModifiedDate
        FROM {customer}""",
    "Person_EmailAddress": """
        SELECT c_custkey AS BusinessEntityID, c_custkey AS EmailAddressID,
          concat(lower(c_mktsegment), cast(c_custkey AS varchar(30)), '@example.org') AS EmailAddress,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {customer}""",
    "Person_PersonPhone": """
        SELECT c_custkey AS BusinessEntityID, cast(5550000 + c_custkey AS varchar(30)) AS PhoneNumber,
          1 AS PhoneNumberTypeID, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {customer}""",
    "Person_StateProvince": """
        SELECT n_nationkey AS StateProvinceID, cast(n_nationkey AS varchar(30)) AS StateProvinceCode,
          cast(n_regionkey AS varchar(30)) AS CountryRegionCode,
          CASE WHEN n_regionkey = 0 THEN false ELSE NULL END AS IsOnlyStateProvinceFlag,
          n_name AS Name, n_nationkey AS TerritoryID,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {nation}""",
    "Person_CountryRegion": """
        SELECT substring(r_name, 1, 2) AS CountryRegionCode, r_name AS Name,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {region}""",
    "Person_Person": """
        SELECT c_custkey AS BusinessEntityID,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'in' WHEN 'MACHINERY' THEN 'XX' ELSE 'SC' END AS PersonType,
          cast(NULL AS boolean) AS NameStyle, cast(NULL AS varchar(30)) AS Title,
          substring(c_name, 1, 8) AS FirstName, cast(NULL AS varchar(30)) AS MiddleName,
          substring(c_name, 10) AS LastName, cast(NULL AS varchar(30)) AS Suffix,
          CASE WHEN c_acctbal < 0 THEN 3 WHEN c_acctbal < 5000 THEN NULL ELSE 1 END AS EmailPromotion,
          cast(NULL AS varchar(30)) AS AdditionalContactInfo,
          concat('<p>', c_mktsegment, '</p>') AS Demographics,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {customer}""",
    "Person_BusinessEntityAddress": """
        SELECT c_custkey AS BusinessEntityID, c_custkey AS AddressID, 2 AS AddressTypeID,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT c_custkey, c_custkey + 1, 3, cast(NULL AS varchar(30)),
          CASE WHEN c_acctbal > 5000 THEN timestamp '2001-02-01 00:00:00' ELSE NULL END
        FROM {customer}""",
    "Production_Product": """
        SELECT p_partkey AS ProductID, p_name AS Name,
          concat('PN-', cast(p_partkey AS varchar(30))) AS ProductNumber,
          cast(NULL AS boolean) AS MakeFlag,
          CASE WHEN p_type = 'PROMO' THEN false ELSE NULL END AS FinishedGoodsFlag,
          substring(p_name, 1, 3) AS Color,
          CASE WHEN p_partkey % 37 = 3 THEN 0 ELSE p_size END AS SafetyStockLevel, p_size - 1 AS ReorderPoint,
          CASE WHEN p_partkey % 37 = 4 THEN cast(-1 AS decimal(19,4))
               ELSE cast(p_retailprice AS decimal(19,4)) END AS StandardCost,
          CASE WHEN p_partkey % 37 = 2 THEN cast(-1 AS decimal(19,4))
               ELSE cast(p_retailprice AS decimal(19,4)) END AS ListPrice,
          cast(p_size AS varchar(30)) AS Size, 'CM' AS SizeUnitMeasureCode,
          cast(NULL AS varchar(30)) AS WeightUnitMeasureCode,
          cast(CASE WHEN p_partkey % 37 = 5 THEN -1 ELSE p_size END AS decimal(8,2)) AS Weight,
          CASE WHEN p_partkey % 37 = 1 THEN -1 ELSE 1 END AS DaysToManufacture,
          CASE WHEN p_partkey % 37 = 6 THEN 'Z' WHEN p_type = 'LARGE' THEN NULL ELSE ' r ' END AS ProductLine,
          CASE WHEN p_brand = 'Brand#13' THEN 'X ' ELSE 'h ' END AS Class,
          CASE WHEN p_partkey % 37 = 8 THEN 'Q' ELSE ' U' END AS Style,
          cast(substring(p_brand, 7) AS int) AS ProductSubcategoryID,
          CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS ProductModelID,
          timestamp '1995-01-01 00:00:00' AS SellStartDate,
          CASE WHEN p_partkey % 37 = 7 THEN timestamp '1994-01-01 00:00:00' ELSE NULL END AS SellEndDate,
          cast(NULL AS timestamp) AS DiscontinuedDate,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {part}""",
    "Production_ProductSubcategory": """
        SELECT cast(substring(p_brand, 7) AS int) AS ProductSubcategoryID, 1 AS ProductCategoryID,
          p_brand AS Name,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT p_brand FROM {part}) brands""",
    "Production_ProductModel": """
        SELECT p_size AS ProductModelID, concat('Model ', cast(p_size AS varchar(30))) AS Name,
          cast(NULL AS varchar(30)) AS CatalogDescription, cast(NULL AS varchar(30)) AS Instructions,
          concat('model-', cast(p_size AS varchar(30))) AS rowguid,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT p_size FROM {part}) sizes""",
    "Production_ProductDescription": """
        SELECT doc_id AS ProductDescriptionID, text AS Description,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {documents}""",
    "Production_ProductCategory": """
        SELECT ascii(p_type) * 1000 + ascii(substring(p_type, 2)) AS ProductCategoryID, p_type AS Name,
          cast(NULL AS varchar(30)) AS rowguid, timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT p_type FROM {part}) types""",
    "Production_UnitMeasure": """
        SELECT substring(p_type, 1, 3) AS UnitMeasureCode, p_type AS Name,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM (SELECT DISTINCT p_type FROM {part}) types""",
    "Production_ProductModelProductDescriptionCulture": """
        SELECT cast(substring(source, 4) AS int) AS ProductModelID, doc_id AS ProductDescriptionID,
          CASE lang WHEN 'de' THEN 'zh-cht' WHEN 'es' THEN 'th    ' ELSE concat(lang, '    ') END
            AS CultureID,
          timestamp '2001-01-01 00:00:00' AS ModifiedDate
        FROM {documents}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dated versions of every part that has a history: one scan, no join."""
    part = table(spark, sf_dir, "part").filter(F.col("p_size") >= FIRST_SIZE_WITH_HISTORY)
    retail = F.col("p_retailprice").cast(MONEY)
    versions = [
        F.struct(
            F.lit(number).alias("ver"),
            F.lit(start).cast("timestamp").alias("sd"),
            F.lit(end).cast("timestamp").alias("ed"),
            (retail * F.lit(share).cast("decimal(4,2)")).cast(MONEY).alias("cost"),
        )
        for number, start, end, share in VERSIONS
    ]
    return part.select("p_partkey", "p_size", F.inline(F.array(*versions)))


def _spoiled(versions: DataFrame) -> DataFrame:
    """Some first versions cost less than nothing, or end before they start."""
    first, number = F.col("ver") == 1, F.col("p_partkey") % 41
    return versions.withColumns(
        {
            "cost": F.when(first & (number == 1), F.lit(-1).cast(MONEY)).otherwise(F.col("cost")),
            "ed": F.when(first & (number == 2), F.lit(LONG_AGO).cast("timestamp")).otherwise(F.col("ed")),
        }
    )


def cost_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spoiled(part_versions(spark, sf_dir)).select(
        F.col("p_partkey").alias("ProductID"),
        F.col("sd").alias("StartDate"),
        F.col("ed").alias("EndDate"),
        F.col("cost").alias("StandardCost"),
        F.lit(LOADED).cast("timestamp").alias("ModifiedDate"),
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List prices; the second period has none."""
    priced = _spoiled(part_versions(spark, sf_dir)).filter(F.col("ver") != 2)
    return priced.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("sd").alias("StartDate"),
        F.col("ed").alias("EndDate"),
        (F.col("cost") * 2).cast(MONEY).alias("ListPrice"),
        F.lit(LOADED).cast("timestamp").alias("ModifiedDate"),
    )


HISTORIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "Production_ProductCostHistory": cost_history,
    "Production_ProductListPriceHistory": price_history,
}


def operational(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One operational table, as the source system would hand it over."""
    if name in HISTORIES:
        return HISTORIES[name](spark, sf_dir)
    query = FEED_SQL[name].replace('"Group"', "`Group`")
    used = set(re.findall(r"\{(\w+)\}", query))
    return spark.sql(query, **{t: table(spark, sf_dir, t) for t in used})


def bronze_like(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows with the audit columns of bronze, load time not yet set."""
    return operational(spark, sf_dir, name).withColumns(
        {
            "_process_timestamp": F.lit(None).cast("timestamp"),
            "_input_file_name": F.lit(f"landing/{name}"),
        }
    )


def unique_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One row per merge key, as a source system with primary keys would hold."""
    spec = SOURCES[name]
    rows = operational(spark, sf_dir, name)
    if spec.modified is None:
        return rows
    rest = [c for c in rows.columns if c not in spec.keys and c != "ModifiedDate"]
    return keep_latest(rows, spec.keys, "ModifiedDate", rest)


def changed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table some time later: rows changed, added and gone, a column new, one gone, keys repeated."""
    rows = operational(spark, sf_dir, name)
    later = "timestamp '2001-02-01 00:00:00' AS ModifiedDate"
    if name == "Sales_Currency":
        extra = spark.sql(f"SELECT 'XXX' AS CurrencyCode, 'Extra unit' AS Name, {later}")
        return rows.filter("CurrencyCode <> 'AFR'").unionByName(extra)
    if name == "Sales_SalesReason":
        extra = spark.sql(f"SELECT 9 AS SalesReasonID, 'New' AS Name, 'Other' AS ReasonType, {later}")
        return rows.filter("SalesReasonID <> 4").unionByName(extra)
    if name == "Sales_SpecialOffer":
        text = F.when(F.col("SpecialOfferID") == 5, F.concat("Description", F.lit("!"))).otherwise(F.col("Description"))
        return rows.filter("SpecialOfferID <> 3").withColumns({"Description": text, "Note": F.lit("new")})
    if name == "Sales_Customer":
        text = F.when(F.col("CustomerID") % 50 == 1, "CHANGED").otherwise(F.col("AccountNumber"))
        return rows.filter("CustomerID % 50 <> 0").withColumn("AccountNumber", text)
    if name == "Production_Product":
        text = F.when(F.col("ProductID") % 40 == 5, "zzz").otherwise(F.col("Color"))
        return rows.filter("ProductID % 40 <> 3").withColumn("Color", text)
    if name == "Sales_SalesOrderHeader":
        return rows.filter("SalesOrderID % 30 <> 0").drop("Comment")
    if name == "Sales_SalesOrderDetail":
        return rows.unionByName(rows.filter("SalesOrderID % 97 = 1"))
    return rows
