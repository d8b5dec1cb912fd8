"""Operational tables of the Production schema.

Fixed values: names, types, keys, defaults and check texts are the data
contract of the source system.
"""

from granary.registry.base import SourceTable

PRODUCTION_TABLES = (
    SourceTable(
        schema="Production",
        name="ProductCostHistory",
        keys=("ProductID", "StartDate"),
        columns="""
            ProductID INT NOT NULL,
            StartDate TIMESTAMP NOT NULL,
            EndDate TIMESTAMP,
            StandardCost DECIMAL(19,4) NOT NULL
        """,
        checks={
            "CK_ProductCostHistory_StandardCost": "StandardCost >= 0",
            "CK_ProductCostHistory_EndDate": "EndDate >= StartDate OR EndDate IS NULL",
        },
    ),
    SourceTable(
        schema="Production",
        name="ProductListPriceHistory",
        keys=("ProductID", "StartDate"),
        columns="""
            ProductID INT NOT NULL,
            StartDate TIMESTAMP NOT NULL,
            EndDate TIMESTAMP,
            ListPrice DECIMAL(19,4) NOT NULL
        """,
        checks={
            "CK_ProductListPriceHistory_ListPrice": "ListPrice >= 0.00",
            "CK_ProductListPriceHistory_EndDate": "EndDate >= StartDate OR EndDate IS NULL",
        },
    ),
    SourceTable(
        schema="Production",
        name="Product",
        keys=("ProductID",),
        columns="""
            ProductID INT NOT NULL,
            Name STRING NOT NULL,
            ProductNumber STRING NOT NULL,
            MakeFlag BOOLEAN NOT NULL,
            FinishedGoodsFlag BOOLEAN NOT NULL,
            Color STRING,
            SafetyStockLevel SMALLINT NOT NULL,
            ReorderPoint SMALLINT NOT NULL,
            StandardCost DECIMAL(19,4) NOT NULL,
            ListPrice DECIMAL(19,4) NOT NULL,
            Size STRING,
            SizeUnitMeasureCode STRING,
            WeightUnitMeasureCode STRING,
            Weight DECIMAL(8,2),
            DaysToManufacture INT NOT NULL,
            ProductLine STRING,
            Class STRING,
            Style STRING,
            ProductSubcategoryID INT,
            ProductModelID INT,
            SellStartDate TIMESTAMP NOT NULL,
            SellEndDate TIMESTAMP,
            DiscontinuedDate TIMESTAMP
        """,
        row_id="NOT NULL",
        constants={"MakeFlag": True, "FinishedGoodsFlag": True},
        trimmed=("Class", "Style", "ProductLine"),
        checks={
            "CK_Product_DaysToManufacture": "DaysToManufacture >= 0",
            "CK_Product_ListPrice": "ListPrice >= 0.00",
            "CK_Product_ReorderPoint": "ReorderPoint > 0",
            "CK_Product_SafetyStockLevel": "SafetyStockLevel > 0",
            "CK_Product_StandardCost": "StandardCost >= 0.00",
            "CK_Product_Weight": "Weight >= 0.00 OR Weight IS NULL",
            "CK_Product_Class": "upper(Class) IN ('H', 'M', 'L') OR Class IS NULL",
            "CK_Product_ProductLine": "upper(ProductLine) IN ('R', 'M', 'T', 'S') OR ProductLine IS NULL",
            "CK_Product_SellEndDate": "SellEndDate >= SellStartDate OR SellEndDate IS NULL",
            "CK_Product_Style": "upper(Style) IN ('U', 'M', 'W') OR Style IS NULL",
        },
    ),
    SourceTable(
        schema="Production",
        name="ProductSubcategory",
        keys=("ProductSubcategoryID",),
        columns="""
            ProductSubcategoryID INT NOT NULL,
            ProductCategoryID INT NOT NULL,
            Name STRING NOT NULL
        """,
        row_id="NOT NULL",
    ),
    SourceTable(
        schema="Production",
        name="ProductModel",
        keys=("ProductModelID",),
        columns="""
            ProductModelID INT NOT NULL,
            Name STRING NOT NULL,
            CatalogDescription STRING,
            Instructions STRING
        """,
        row_id="NOT NULL",
        fill_row_id=False,
    ),
    SourceTable(
        schema="Production",
        name="ProductDescription",
        keys=("ProductDescriptionID",),
        columns="""
            ProductDescriptionID INT NOT NULL,
            Description STRING NOT NULL
        """,
        row_id="NOT NULL",
    ),
    SourceTable(
        schema="Production",
        name="ProductCategory",
        keys=("ProductCategoryID",),
        columns="""
            ProductCategoryID INT NOT NULL,
            Name STRING NOT NULL
        """,
        row_id="NOT NULL",
    ),
    SourceTable(
        schema="Production",
        name="UnitMeasure",
        keys=("UnitMeasureCode",),
        columns="""
            UnitMeasureCode STRING NOT NULL,
            Name STRING NOT NULL
        """,
    ),
    SourceTable(
        schema="Production",
        name="ProductModelProductDescriptionCulture",
        keys=("ProductModelID", "ProductDescriptionID", "CultureID"),
        columns="""
            ProductModelID INT NOT NULL,
            ProductDescriptionID INT NOT NULL,
            CultureID STRING NOT NULL
        """,
    ),
)
