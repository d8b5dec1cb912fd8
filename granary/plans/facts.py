"""Fact builds: order lines and their sales reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.calendar import date_key
from granary.functions.sales import discount_amount, order_id, product_cost, sales_amount
from granary.operators.dedup import one_per_key
from granary.operators.fills import AsOf
from granary.operators.history import join_as_of, join_valid_version
from granary.operators.joins import by_measure
from granary.operators.ordered import number_in_lanes, split_groups
from granary.operators.shaping import project
from granary.registry import WAREHOUSE
from granary.session import stored

Frames = Mapping[str, DataFrame]

MANY_VERSIONS = 64  # of one product, that each of its lines may meet
LANE = 1 << 20  # ids of order lines that are numbered together

# Dimensions the sales fact looks up, with the columns it reads of each.
LOOKUPS = {
    "DimProduct": ("ProductAlternateKey", "StandardCost", "StartDate", "EndDate"),
    "DimPromotion": ("PromotionAlternateKey",),
    "DimSalesTerritory": ("SalesTerritoryAlternateKey",),
    "DimCurrency": ("CurrencyAlternateKey",),
}


def territory_lookup(silver: Frames, gold: Frames) -> DataFrame:
    """Territory to its surrogate key and the surrogate key of its currency.

    Every territory has one country, every country is given its lowest
    currency code, so the four small lookups fold into one and the fact joins
    once where it would join four times.
    """
    currency = one_per_key(
        silver["CountryRegionCurrency"].select("CountryRegionCode", "CurrencyCode"),
        ["CountryRegionCode"],
        ["CurrencyCode"],
    )
    source = (
        silver["SalesTerritory"]
        .alias("t")
        .join(currency.alias("cc"), F.col("t.CountryRegionCode") == F.col("cc.CountryRegionCode"), "left")
        .join(
            gold["DimCurrency"].alias("cu"),
            F.col("cc.CurrencyCode") == F.col("cu.CurrencyAlternateKey"),
            "left",
        )
        .select("t.TerritoryID", "cu.CurrencyKey")
    )
    return (
        source.alias("t")
        .join(
            gold["DimSalesTerritory"].alias("dt"),
            F.col("t.TerritoryID") == F.col("dt.SalesTerritoryAlternateKey"),
            "full",
        )
        .select(
            F.coalesce("t.TerritoryID", "dt.SalesTerritoryAlternateKey").alias("TerritoryID"),
            "dt.SalesTerritoryKey",
            "t.CurrencyKey",
        )
    )


def product_versions(silver: Frames, gold: Frames) -> DataFrame:
    """Dimension versions by product id, so that the fact joins products once."""
    product, versions = silver["Product"].alias("p"), gold["DimProduct"].hint("merge").alias("d")
    return product.join(
        versions, F.col("p.ProductNumber") == F.col("d.ProductAlternateKey"), "inner"
    ).select("p.ProductID", "d.ProductKey", "d.StandardCost", "d.StartDate", "d.EndDate")


def line_lane(detail_id: str) -> Column:
    """Lines of an order with neighbouring ids; an order of very many lines has several lanes."""
    return F.floor(F.col(detail_id) / LANE).cast("bigint")


def orders_in_lanes(silver: Frames) -> DataFrame:
    """Orders whose line numbers run over several lanes: long ones, and those that share an order number."""
    detail, header = silver["SalesOrderDetail"], silver["SalesOrderHeader"]
    long = split_groups(detail, "SalesOrderID", line_lane("SalesOrderDetailID"))
    shared = split_groups(header, "SalesOrderNumber", F.col("SalesOrderID"))
    shared = stored(shared, "shared-numbers")
    if not shared.isEmpty():
        doubled = header.join(by_measure(shared), "SalesOrderNumber", "left_semi").select("SalesOrderID")
        long = long.unionByName(doubled).distinct()
    return stored(long, "orders-in-lanes")


def fact_internet_sales(silver: Frames, gold: Frames, as_of: AsOf = None) -> DataFrame:
    """Lines of online orders with their surrogate keys, line numbers and amounts.

    The two folded lookups are stored first, so that their size decides: small
    ones are broadcast, and those whose rows pass the broadcast limit in memory
    are sort-merged, whatever their files' size; so are headers that the caller
    has measured.
    Adaptive execution splits hot products, orders and territories. Lines are
    numbered in the partitioning by order that their join with the header
    leaves, so the joined rows are neither shuffled nor sorted as a whole.
    """
    versions = by_measure(stored(product_versions(silver, gold), "product-versions"))
    territories = by_measure(stored(territory_lookup(silver, gold), "territories"))
    gold = {**gold, "DimPromotion": by_measure(gold["DimPromotion"])}
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    in_lanes = orders_in_lanes(silver)
    detail = silver["SalesOrderDetail"]
    split = None
    if not in_lanes.isEmpty():
        few = detail.join(by_measure(in_lanes), "SalesOrderID", "left_semi")
        split = sales_lines(few, silver, versions, territories, gold, today)
    named = sales_lines(detail, silver, versions, territories, gold, today)
    numbered = number_in_lanes(
        named,
        ["SalesOrderNumber"],
        ["_order", "_lane"],
        ["_line", "ProductKey"],
        "SalesOrderLineNumber",
        named.limit(0) if split is None else split,
    )
    line = F.col("SalesOrderLineNumber").cast("tinyint")
    return numbered.withColumn("SalesOrderLineNumber", line).select(*WAREHOUSE["FactInternetSales"].struct.names)


def sales_lines(
    detail: DataFrame, silver: Frames, versions: DataFrame, territories: DataFrame, gold: Frames, today: Column
) -> DataFrame:
    """The fact's columns of the online lines in ``detail``, with the order, lane and id of each line."""
    online = silver["SalesOrderHeader"].filter(F.col("OnlineOrderFlag"))
    lines = detail.alias("l").join(
        online.alias("h"), F.col("l.SalesOrderID") == F.col("h.SalesOrderID"), "inner"
    )
    product, ordered, as_of = F.col("l.ProductID"), F.col("h.OrderDate"), today.cast("timestamp")
    if (versions.groupBy("ProductID").count().agg(F.max("count")).first()[0] or 0) > MANY_VERSIONS:
        # One candidate per line, where a product has more versions than a line should meet.
        priced = join_as_of(lines, versions, [product], ordered, ["ProductID"], "StartDate", "EndDate", as_of)
    else:
        own = product == F.col("v.ProductID")
        valid = (F.col("v.StartDate"), F.col("v.EndDate"))
        priced = join_valid_version(lines, versions.alias("v"), own, ordered, *valid, as_of)
    joined = priced.join(
        gold["DimPromotion"].alias("pr"),
        F.col("l.SpecialOfferID") == F.col("pr.PromotionAlternateKey"),
        "left",
    ).join(
        territories.alias("te"),
        F.col("h.TerritoryID") == F.col("te.TerritoryID"),
        "left",
    )
    discount, unit_price = F.col("l.UnitPriceDiscount"), F.col("l.UnitPrice")
    return project(
        joined,
        {
            "ProductKey": "v.ProductKey",
            "OrderDateKey": date_key(F.col("h.OrderDate")),
            "DueDateKey": date_key(F.col("h.DueDate")),
            "ShipDateKey": date_key(F.col("h.ShipDate")),
            "CustomerKey": "h.CustomerID",
            "PromotionKey": "pr.PromotionKey",
            "CurrencyKey": "te.CurrencyKey",
            "SalesTerritoryKey": "te.SalesTerritoryKey",
            "SalesOrderNumber": "h.SalesOrderNumber",
            "RevisionNumber": "h.RevisionNumber",
            "OrderQuantity": "l.OrderQty",
            "UnitPrice": "l.UnitPrice",
            "ExtendedAmount": "l.LineTotal",
            "UnitPriceDiscountPct": "l.UnitPriceDiscount",
            "DiscountAmount": discount_amount(discount, unit_price),
            "ProductStandardCost": "v.StandardCost",
            "TotalProductCost": product_cost(F.col("l.OrderQty"), F.col("v.StandardCost")),
            "SalesAmount": sales_amount(F.col("l.LineTotal"), discount, unit_price),
            "TaxAmt": "h.TaxAmt",
            "Freight": "h.Freight",
            "CarrierTrackingNumber": "l.CarrierTrackingNumber",
            "CustomerPONumber": "h.PurchaseOrderNumber",
            "OrderDate": "h.OrderDate",
            "DueDate": "h.DueDate",
            "ShipDate": "h.ShipDate",
            "_order": "l.SalesOrderID",
            "_lane": line_lane("l.SalesOrderDetailID"),
            "_line": "l.SalesOrderDetailID",
        },
    )


def fact_internet_sales_reason(fact: DataFrame, silver: Frames) -> DataFrame:
    """Sales reasons of each fact line, through the number behind the order number.

    Lines without a reason have no row, so an inner join says it directly.
    """
    lines = fact.select(
        "SalesOrderNumber",
        "SalesOrderLineNumber",
        order_id(F.col("SalesOrderNumber")).alias("SalesOrderID"),
    )
    bridge = silver["SalesOrderHeaderSalesReason"].select(
        F.col("SalesOrderID").cast("bigint").alias("SalesOrderID"),
        F.col("SalesReasonID").alias("SalesReasonKey"),
    )
    return lines.join(bridge.filter(F.col("SalesReasonKey").isNotNull()).hint("merge"), "SalesOrderID").select(
        "SalesOrderNumber", "SalesOrderLineNumber", "SalesReasonKey"
    )
