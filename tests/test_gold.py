"""Gold builds on small hand-made silver frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from granary.operators.identity import assign_identity
from granary.operators.sync import duplicate_keys, to_sink
from granary.plans import dimensions, facts
from granary.registry import WAREHOUSE, source

AS_OF = "2020-01-01 00:00:00"


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def silver(spark):
    """Silver frames from dicts; columns that are not named are NULL."""

    def build(**tables):
        frames = {}
        for name, items in tables.items():
            struct = StructType([StructField(f.name, f.dataType) for f in source(name).struct])
            data = [tuple(item.get(c) for c in struct.names) for item in items]
            frames[name] = spark.createDataFrame(data, struct)
        return frames

    return build


def keyed(rows, name):
    spec = WAREHOUSE[name]
    return assign_identity(to_sink(rows, spec.struct, (spec.identity,)), None, spec.keys, spec.identity)[0]


PRODUCTS = dict(
    Product=[
        {"ProductID": 1, "Name": "Bike", "ProductNumber": "BK-1", "FinishedGoodsFlag": True, "ProductModelID": 10},
        {"ProductID": 2, "Name": "Bell", "ProductNumber": "BL-2", "FinishedGoodsFlag": True, "ProductModelID": 11},
        {"ProductID": 3, "Name": "Bolt", "ProductNumber": "BO-3", "FinishedGoodsFlag": False},
    ],
    ProductModel=[{"ProductModelID": 10, "Name": "Road"}],
    ProductDescription=[
        {"ProductDescriptionID": 100, "Description": "fast"},
        {"ProductDescriptionID": 101, "Description": "vite"},
        {"ProductDescriptionID": 102, "Description": "loud"},
        {"ProductDescriptionID": 103, "Description": "faster"},
    ],
    ProductModelProductDescriptionCulture=[
        {"ProductModelID": 10, "ProductDescriptionID": 100, "CultureID": "en    "},
        {"ProductModelID": 10, "ProductDescriptionID": 103, "CultureID": "en    "},
        {"ProductModelID": 10, "ProductDescriptionID": 101, "CultureID": "fr    "},
        {"ProductModelID": 11, "ProductDescriptionID": 102, "CultureID": "en"},
    ],
    ProductCostHistory=[
        {"ProductID": 1, "StartDate": day("2011-01-01"), "EndDate": day("2011-12-31"), "StandardCost": Decimal(5)},
        {"ProductID": 1, "StartDate": day("2012-01-01"), "EndDate": None, "StandardCost": Decimal(6)},
        {"ProductID": 2, "StartDate": day("2011-01-01"), "EndDate": None, "StandardCost": Decimal(1)},
    ],
    ProductListPriceHistory=[
        {"ProductID": 1, "StartDate": day("2011-01-01"), "EndDate": day("2011-12-30"), "ListPrice": Decimal(9)},
        {"ProductID": 1, "StartDate": day("2012-01-01"), "EndDate": None, "ListPrice": Decimal(11)},
    ],
)


def test_product_versions(silver, rows):
    out = dimensions.dim_product(silver(**PRODUCTS)).select(
        "ProductAlternateKey", "StartDate", "StandardCost", "ListPrice", "Status", "ModelName",
        "EnglishDescription", "FrenchDescription", "ThaiDescription",
    )
    assert rows(out) == [
        ("BK-1", day("2011-01-01"), Decimal(5), None, None, "Road", "fast", "vite", None),
        ("BK-1", day("2012-01-01"), Decimal(6), Decimal(11), "Current", "Road", "fast", "vite", None),
        ("BL-2", day("2011-01-01"), Decimal(1), None, "Current", None, "loud", None, None),
        ("BO-3", None, None, None, "Current", None, None, None, None),
    ]


def test_dimensions_have_the_columns_of_their_tables(silver):
    names = {n for spec in WAREHOUSE.values() for n in spec.sources}
    frames = silver(**{n: [] for n in names})
    for name, build in dimensions.DIMENSIONS.items():
        spec = WAREHOUSE[name]
        assert to_sink(build(frames), spec.struct, (spec.identity,)).columns == [
            c for c in spec.struct.names if c != spec.identity
        ]


CUSTOMERS = dict(
    Customer=[
        {"CustomerID": 1, "PersonID": 7, "AccountNumber": "AW1"},
        {"CustomerID": 2, "PersonID": 8, "AccountNumber": "AW2"},
    ],
    Person=[{"BusinessEntityID": 7, "FirstName": "A", "NameStyle": False}],
    PersonPhone=[
        {"BusinessEntityID": 7, "PhoneNumber": "222", "PhoneNumberTypeID": 1},
        {"BusinessEntityID": 7, "PhoneNumber": "111", "PhoneNumberTypeID": 2},
    ],
    EmailAddress=[{"BusinessEntityID": 7, "EmailAddressID": 1, "EmailAddress": "a@b"}],
    BusinessEntityAddress=[{"BusinessEntityID": 7, "AddressID": 3}],
    Address=[{"AddressID": 3, "AddressLine1": "Street 1"}],
    vPersonDemographics=[
        {"BusinessEntityID": 7, "BirthDate": day("1980-05-06"), "TotalChildren": 2, "HomeOwnerFlag": True}
    ],
)


def test_customer_joins(silver, rows):
    frames = silver(**CUSTOMERS)
    spec = WAREHOUSE["DimCustomer"]
    twice = to_sink(dimensions.dim_customer(frames), spec.struct)
    assert rows(duplicate_keys(twice, spec.keys)) == [(1, 2)]
    once = to_sink(dimensions.dim_customer(frames, one_contact=True), spec.struct)
    picked = once.select(
        "CustomerKey", "FirstName", "Phone", "EmailAddress", "AddressLine1", "BirthDate", "TotalChildren",
        "HouseOwnerFlag",
    )
    assert rows(picked) == [
        (1, "A", "111", "a@b", "Street 1", dt.date(1980, 5, 6), 2, "true"),
        (2, None, None, None, None, None, None, None),
    ]


def order(number, when, online=True, territory=1, name=None):
    return {
        "SalesOrderID": number, "SalesOrderNumber": name or f"SO{number}", "OrderDate": day(when),
        "DueDate": day(when), "OnlineOrderFlag": online, "TerritoryID": territory, "CustomerID": 1,
        "RevisionNumber": 1, "TaxAmt": Decimal(1), "Freight": Decimal(2),
    }


def line(number, detail, product, discount="0", offer=1):
    return {
        "SalesOrderID": number, "SalesOrderDetailID": detail, "ProductID": product, "OrderQty": 3,
        "SpecialOfferID": offer, "UnitPrice": Decimal(10), "UnitPriceDiscount": Decimal(discount),
        "LineTotal": Decimal(30),
    }


@pytest.fixture
def sales(silver):
    frames = silver(
        **PRODUCTS,
        SalesOrderHeader=[
            order(1, "2011-12-31"),
            order(2, "2012-01-01", territory=2),
            order(3, "2010-01-01", territory=None),
            order(4, "2012-05-05", online=False),
        ],
        SalesOrderDetail=[
            line(1, 12, 2), line(1, 11, 1, "0.10"), line(2, 20, 1), line(3, 30, 1), line(3, 31, 3),
            line(4, 40, 1), line(9, 90, 1),
        ],
        SalesTerritory=[
            {"TerritoryID": 1, "Name": "North", "CountryRegionCode": "DE", "Group": "EU"},
            {"TerritoryID": 2, "Name": "South", "CountryRegionCode": "XX", "Group": "EU"},
        ],
        CountryRegion=[{"CountryRegionCode": "DE", "Name": "Germany"}, {"CountryRegionCode": "XX", "Name": "X"}],
        CountryRegionCurrency=[
            {"CountryRegionCode": "DE", "CurrencyCode": "EUR"},
            {"CountryRegionCode": "DE", "CurrencyCode": "DEM"},
        ],
        Currency=[{"CurrencyCode": "EUR", "Name": "Euro"}, {"CurrencyCode": "DEM", "Name": "Mark"}],
        SpecialOffer=[{"SpecialOfferID": 1, "StartDate": day("2010-01-01")}],
        SalesOrderHeaderSalesReason=[
            {"SalesOrderID": 1, "SalesReasonID": 5},
            {"SalesOrderID": 1, "SalesReasonID": 6},
            {"SalesOrderID": 3, "SalesReasonID": None},
        ],
    )
    gold = {n: keyed(dimensions.DIMENSIONS[n](frames), n) for n in facts.LOOKUPS}
    return frames, gold


def test_sales_fact(sales, rows):
    frames, gold = sales
    fact = to_sink(facts.fact_internet_sales(frames, gold, AS_OF), WAREHOUSE["FactInternetSales"].struct)
    number = {(r.ProductAlternateKey, r.StartDate): r.ProductKey for r in gold["DimProduct"].collect()}
    currency = {r.CurrencyAlternateKey: r.CurrencyKey for r in gold["DimCurrency"].collect()}
    bike_old, bike_new = number["BK-1", day("2011-01-01")], number["BK-1", day("2012-01-01")]
    bell = number["BL-2", day("2011-01-01")]
    picked = fact.select("SalesOrderNumber", "SalesOrderLineNumber", "ProductKey", "CurrencyKey", "OrderDateKey")
    # Offline orders, lines without a header and undated versions find no match.
    assert rows(picked) == [
        ("SO1", 1, bike_old, currency["DEM"], 20111231),
        ("SO1", 2, bell, currency["DEM"], 20111231),
        ("SO2", 1, bike_new, None, 20120101),
        ("SO3", 1, None, None, 20100101),
        ("SO3", 2, None, None, 20100101),
    ]
    first = fact.filter("SalesOrderNumber = 'SO1' and SalesOrderLineNumber = 1").first()
    assert (first.SalesAmount, first.TotalProductCost, first.PromotionKey) == (Decimal(29), Decimal(15), 1)
    assert first.DiscountAmount == pytest.approx(1.0)


def test_reason_fact(sales, rows):
    frames, gold = sales
    fact = facts.fact_internet_sales(frames, gold, AS_OF)
    assert rows(facts.fact_internet_sales_reason(fact, frames)) == [
        ("SO1", 1, 5), ("SO1", 1, 6), ("SO1", 2, 5), ("SO1", 2, 6),
    ]


def test_one_row_per_territory_in_the_lookup(sales):
    frames, gold = sales
    lookup = facts.territory_lookup(frames, gold)
    assert lookup.groupBy("TerritoryID").count().filter(F.col("count") > 1).count() == 0
