"""Dimension builds: silver DataFrames in, gold columns without surrogate keys out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.calendar import calendar_columns
from granary.operators.conform import typed_null
from granary.operators.dedup import one_per_key
from granary.operators.history import match_open_ranges
from granary.operators.joins import by_measure, left_join_many
from granary.operators.shaping import pivot_first, project
from granary.registry import WAREHOUSE
from granary.session import stored

Frames = Mapping[str, DataFrame]

FIRST_DAY, LAST_DAY = "2005-01-01", "2014-12-31"

# Culture code to the name the description column starts with.
CULTURES = {
    "en": "English",
    "fr": "French",
    "zh-cht": "Chinese",
    "ar": "Arabic",
    "he": "Hebrew",
    "th": "Thai",
}


def _placeholders(table: str, *columns: str) -> dict:
    types = {f.name: f.dataType for f in WAREHOUSE[table].struct}
    return {c: typed_null(types[c]) for c in columns}


def _ordered(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order, without the surrogate key."""
    spec = WAREHOUSE[table]
    return df.select(*[n for n in spec.struct.names if n != spec.identity])


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    span = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return describe_days(spark.range(1).select(F.explode(span).alias("day")))


def describe_days(days: DataFrame) -> DataFrame:
    """All DimDate columns for a frame with a ``day`` column."""
    return project(days, calendar_columns("day"))


def dim_currency(silver: Frames) -> DataFrame:
    return project(
        silver["Currency"], {"CurrencyAlternateKey": "CurrencyCode", "CurrencyName": "Name"}
    )


def dim_sales_reason(silver: Frames) -> DataFrame:
    return project(
        silver["SalesReason"],
        {
            "SalesReasonAlternateKey": "SalesReasonID",
            "SalesReasonName": "Name",
            "SalesReasonReasonType": "ReasonType",
        },
    )


def dim_promotion(silver: Frames) -> DataFrame:
    named = project(
        silver["SpecialOffer"],
        {
            "PromotionAlternateKey": "SpecialOfferID",
            "EnglishPromotionName": "Description",
            "DiscountPct": "DiscountPct",
            "EnglishPromotionType": "Type",
            "EnglishPromotionCategory": "Category",
            "StartDate": "StartDate",
            "EndDate": "EndDate",
            "MinQty": "MinQty",
            "MaxQty": "MaxQty",
        },
    )
    foreign = [
        f"{language}Promotion{part}"
        for language in ("Spanish", "French")
        for part in ("Name", "Type", "Category")
    ]
    return _ordered(named.withColumns(_placeholders("DimPromotion", *foreign)), "DimPromotion")


def dim_sales_territory(silver: Frames) -> DataFrame:
    territory, country = silver["SalesTerritory"].alias("t"), silver["CountryRegion"].alias("c")
    joined = territory.join(
        country, F.col("t.CountryRegionCode") == F.col("c.CountryRegionCode"), "left"
    )
    return project(
        joined,
        {
            "SalesTerritoryAlternateKey": "t.TerritoryID",
            "SalesTerritoryRegion": "t.Name",
            "SalesTerritoryCountry": "c.Name",
            "SalesTerritoryGroup": "t.Group",
        }
        | _placeholders("DimSalesTerritory", "SalesTerritoryImage"),
    )


def repeated_contacts(silver: Frames) -> DataFrame:
    """Persons with several phones or email addresses, from the narrow key columns."""
    kinds = {"PersonPhone": "phone", "EmailAddress": "email"}
    found = [
        silver[name].groupBy("BusinessEntityID").count().filter("count > 1").withColumn("contact", F.lit(kind))
        for name, kind in kinds.items()
    ]
    return found[0].unionByName(found[1])


def dim_customer(silver: Frames, one_contact: bool = False) -> DataFrame:
    """Customers with their person, contacts, address and demographics.

    Addresses meet their entity first. All joins to the customer are then on
    the person, so the customer side shuffles once for the five of them; all
    sides grow with the customers, so none is broadcast for its files' size. A
    person with several phones or email addresses would repeat the customer:
    the load refuses it ahead of the joins, see :func:`repeated_contacts`;
    ``one_contact`` keeps the lowest of each instead.
    """
    phones = silver["PersonPhone"].select("BusinessEntityID", "PhoneNumber")
    emails = silver["EmailAddress"].select("BusinessEntityID", "EmailAddressID", "EmailAddress")
    if one_contact:
        phones = one_per_key(phones, ["BusinessEntityID"], ["PhoneNumber"])
        emails = one_per_key(emails, ["BusinessEntityID"], ["EmailAddressID"])
    located = silver["BusinessEntityAddress"].alias("e").join(
        silver["Address"].hint("merge").alias("a"), F.col("e.AddressID") == F.col("a.AddressID"), "left"
    ).select("e.BusinessEntityID", "a.AddressLine1", "a.AddressLine2")

    joined = silver["Customer"].alias("c")
    for name, details in {
        "p": silver["Person"],
        "ph": phones,
        "em": emails,
        "ad": located,
        "d": silver["vPersonDemographics"],
    }.items():
        same_person = F.col("c.PersonID") == F.col(f"{name}.BusinessEntityID")
        joined = joined.join(details.hint("merge").alias(name), same_person, "left")

    named = project(
        joined,
        {
            "CustomerKey": "c.CustomerID",
            "CustomerAlternateKey": "c.AccountNumber",
            "Title": "p.Title",
            "FirstName": "p.FirstName",
            "MiddleName": "p.MiddleName",
            "LastName": "p.LastName",
            "NameStyle": "p.NameStyle",
            "BirthDate": "d.BirthDate",
            "MaritalStatus": "d.MaritalStatus",
            "Suffix": "p.Suffix",
            "Gender": "d.Gender",
            "EmailAddress": "em.EmailAddress",
            "YearlyIncome": "d.YearlyIncome",
            "TotalChildren": "d.TotalChildren",
            "NumberChildrenAtHome": "d.NumberChildrenAtHome",
            "EnglishEducation": "d.Education",
            "EnglishOccupation": "d.Occupation",
            "HouseOwnerFlag": "d.HomeOwnerFlag",
            "NumberCarsOwned": "d.NumberCarsOwned",
            "AddressLine1": "ad.AddressLine1",
            "AddressLine2": "ad.AddressLine2",
            "Phone": "ph.PhoneNumber",
            "DateFirstPurchase": "d.DateFirstPurchase",
        },
    )
    unknown = (
        "GeographyKey",
        "SpanishEducation",
        "FrenchEducation",
        "SpanishOccupation",
        "FrenchOccupation",
        "CommuteDistance",
    )
    return _ordered(named.withColumns(_placeholders("DimCustomer", *unknown)), "DimCustomer")


def product_descriptions(silver: Frames) -> DataFrame:
    """One row per model with its first description in each culture.

    The first description is chosen by its id before any text is fetched, so
    the texts that lose out are never shuffled.
    """
    bridge = silver["ProductModelProductDescriptionCulture"].select(
        "ProductModelID", F.trim("CultureID").alias("Culture"), "ProductDescriptionID"
    )
    chosen = (
        bridge.filter(F.col("Culture").isin(*CULTURES))
        .groupBy("ProductModelID", "Culture")
        .agg(F.min("ProductDescriptionID").alias("ProductDescriptionID"))
    )
    text = silver["ProductDescription"].select("ProductDescriptionID", "Description")
    return pivot_first(
        chosen.join(text, "ProductDescriptionID", "left"),
        ["ProductModelID"],
        F.col("Culture"),
        {code: f"{language}Description" for code, language in CULTURES.items()},
        "Description",
        "ProductDescriptionID",
    )


def product_history(silver: Frames) -> DataFrame:
    """Cost history with the list price of the same period."""
    cost, price = silver["ProductCostHistory"].alias("c"), silver["ProductListPriceHistory"].alias("l")
    same_period = (
        (F.col("c.ProductID") == F.col("l.ProductID"))
        & (F.col("c.StartDate") == F.col("l.StartDate"))
        & match_open_ranges(F.col("c.EndDate"), F.col("l.EndDate"))
    )
    return cost.join(price.hint("merge"), same_period, "left").select(
        "c.ProductID", "c.StartDate", "c.EndDate", "c.StandardCost", "l.ListPrice"
    )


def dim_product(silver: Frames) -> DataFrame:
    """One row per product version, or one undated row for a product without history."""
    return _ordered(describe_products(product_rows(silver), silver), "DimProduct")


def product_rows(silver: Frames) -> DataFrame:
    """The rows of :func:`dim_product` without what :func:`describe_products` adds, and their model as ``_model``."""
    history = product_history(silver).withColumnsRenamed(
        {"StandardCost": "VersionCost", "ListPrice": "VersionPrice"}
    )
    versions = left_join_many(silver["Product"], history, "ProductID").alias("p")
    return project(
        versions,
        {
            "_model": "p.ProductModelID",
            "ProductAlternateKey": "p.ProductNumber",
            "ProductSubcategoryKey": "p.ProductSubcategoryID",
            "WeightUnitMeasureCode": "p.WeightUnitMeasureCode",
            "SizeUnitMeasureCode": "p.SizeUnitMeasureCode",
            "EnglishProductName": "p.Name",
            "StandardCost": "p.VersionCost",
            "FinishedGoodsFlag": "p.FinishedGoodsFlag",
            "Color": "p.Color",
            "SafetyStockLevel": "p.SafetyStockLevel",
            "ReorderPoint": "p.ReorderPoint",
            "ListPrice": "p.VersionPrice",
            "Size": "p.Size",
            "Weight": "p.Weight",
            "DaysToManufacture": "p.DaysToManufacture",
            "ProductLine": "p.ProductLine",
            "Class": "p.Class",
            "Style": "p.Style",
            "StartDate": "p.StartDate",
            "EndDate": "p.EndDate",
            "Status": F.when(F.col("p.EndDate").isNull(), "Current"),
        },
    )


def describe_products(rows: DataFrame, silver: Frames) -> DataFrame:
    """Adds model names and descriptions to :func:`product_rows`, keyed or not, and the columns nothing is known of.

    Model and text meet first and are stored, so that the products join them
    once, and by their size.
    """
    model, text = silver["ProductModel"].alias("m"), product_descriptions(silver).alias("t")
    described = model.join(
        text, F.col("m.ProductModelID") == F.col("t.ProductModelID"), "full"
    ).select(
        F.coalesce("m.ProductModelID", "t.ProductModelID").alias("_described"),
        F.col("m.Name").alias("ModelName"),
        *[f"t.{language}Description" for language in CULTURES.values()],
    )
    described = by_measure(stored(described, "described"))
    joined = rows.join(described, F.col("_model") == F.col("_described"), "left").drop("_model", "_described")
    unknown = (
        "SpanishProductName",
        "FrenchProductName",
        "SizeRange",
        "DealerPrice",
        "LargePhoto",
        "GermanDescription",
        "JapaneseDescription",
        "TurkishDescription",
    )
    return joined.withColumns(_placeholders("DimProduct", *unknown))


# Dimensions whose long texts are added when their rows have surrogate keys.
FINISHED = {"DimProduct": (product_rows, describe_products)}

DIMENSIONS = {
    "DimProduct": dim_product,
    "DimCurrency": dim_currency,
    "DimPromotion": dim_promotion,
    "DimCustomer": dim_customer,
    "DimSalesTerritory": dim_sales_territory,
    "DimSalesReason": dim_sales_reason,
}
