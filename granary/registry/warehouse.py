"""Gold tables of the internet sales star schema.

Fixed values: column names, types and keys are the contract with reports.
Surrogate keys are BIGINT in the dimensions and stay BIGINT in the fact.
"""

from granary.registry.base import WarehouseTable

WAREHOUSE_TABLES = (
    WarehouseTable(
        name="DimProduct",
        keys=("ProductAlternateKey", "StartDate"),
        identity="ProductKey",
        # Products without history have no start date and still keep their key.
        null_safe_keys=True,
        sources=(
            "Product",
            "ProductModel",
            "ProductDescription",
            "ProductModelProductDescriptionCulture",
            "ProductCostHistory",
            "ProductListPriceHistory",
        ),
        columns="""
            ProductKey BIGINT,
            ProductAlternateKey STRING,
            ProductSubcategoryKey INT,
            WeightUnitMeasureCode STRING,
            SizeUnitMeasureCode STRING,
            EnglishProductName STRING NOT NULL,
            SpanishProductName STRING,
            FrenchProductName STRING,
            StandardCost DECIMAL(19,4),
            FinishedGoodsFlag BOOLEAN NOT NULL,
            Color STRING,
            SafetyStockLevel SMALLINT,
            ReorderPoint SMALLINT,
            ListPrice DECIMAL(19,4),
            Size STRING,
            SizeRange STRING,
            Weight FLOAT,
            DaysToManufacture INT,
            ProductLine STRING,
            DealerPrice DECIMAL(19,4),
            Class STRING,
            Style STRING,
            ModelName STRING,
            LargePhoto BINARY,
            EnglishDescription STRING,
            FrenchDescription STRING,
            ChineseDescription STRING,
            ArabicDescription STRING,
            HebrewDescription STRING,
            ThaiDescription STRING,
            GermanDescription STRING,
            JapaneseDescription STRING,
            TurkishDescription STRING,
            StartDate TIMESTAMP,
            EndDate TIMESTAMP,
            Status STRING
        """,
    ),
    WarehouseTable(
        name="DimCurrency",
        keys=("CurrencyAlternateKey",),
        unique_by_build=True,
        identity="CurrencyKey",
        sources=("Currency",),
        columns="""
            CurrencyKey BIGINT,
            CurrencyAlternateKey STRING,
            CurrencyName STRING
        """,
    ),
    WarehouseTable(
        name="DimPromotion",
        keys=("PromotionAlternateKey",),
        unique_by_build=True,
        identity="PromotionKey",
        sources=("SpecialOffer",),
        columns="""
            PromotionKey BIGINT,
            PromotionAlternateKey INT,
            EnglishPromotionName STRING,
            SpanishPromotionName STRING,
            FrenchPromotionName STRING,
            DiscountPct FLOAT,
            EnglishPromotionType STRING,
            SpanishPromotionType STRING,
            FrenchPromotionType STRING,
            EnglishPromotionCategory STRING,
            SpanishPromotionCategory STRING,
            FrenchPromotionCategory STRING,
            StartDate TIMESTAMP NOT NULL,
            EndDate TIMESTAMP,
            MinQty INT,
            MaxQty INT
        """,
    ),
    WarehouseTable(
        name="DimCustomer",
        keys=("CustomerKey",),
        sources=(
            "Customer",
            "Person",
            "PersonPhone",
            "EmailAddress",
            "BusinessEntityAddress",
            "Address",
            "vPersonDemographics",
        ),
        columns="""
            CustomerKey INT NOT NULL,
            GeographyKey INT,
            CustomerAlternateKey STRING NOT NULL,
            Title STRING,
            FirstName STRING,
            MiddleName STRING,
            LastName STRING,
            NameStyle BOOLEAN,
            BirthDate DATE,
            MaritalStatus STRING,
            Suffix STRING,
            Gender STRING,
            EmailAddress STRING,
            YearlyIncome STRING,
            TotalChildren TINYINT,
            NumberChildrenAtHome TINYINT,
            EnglishEducation STRING,
            SpanishEducation STRING,
            FrenchEducation STRING,
            EnglishOccupation STRING,
            SpanishOccupation STRING,
            FrenchOccupation STRING,
            HouseOwnerFlag STRING,
            NumberCarsOwned TINYINT,
            AddressLine1 STRING,
            AddressLine2 STRING,
            Phone STRING,
            DateFirstPurchase DATE,
            CommuteDistance STRING
        """,
    ),
    WarehouseTable(
        name="DimSalesTerritory",
        keys=("SalesTerritoryAlternateKey",),
        unique_by_build=True,
        identity="SalesTerritoryKey",
        sources=("SalesTerritory", "CountryRegion"),
        columns="""
            SalesTerritoryKey BIGINT,
            SalesTerritoryAlternateKey INT,
            SalesTerritoryRegion STRING NOT NULL,
            SalesTerritoryCountry STRING NOT NULL,
            SalesTerritoryGroup STRING,
            SalesTerritoryImage BINARY
        """,
    ),
    WarehouseTable(
        name="DimSalesReason",
        keys=("SalesReasonAlternateKey",),
        unique_by_build=True,
        identity="SalesReasonKey",
        sources=("SalesReason",),
        columns="""
            SalesReasonKey BIGINT,
            SalesReasonAlternateKey INT NOT NULL,
            SalesReasonName STRING NOT NULL,
            SalesReasonReasonType STRING NOT NULL
        """,
    ),
    WarehouseTable(
        name="DimDate",
        keys=("DateKey",),
        unique_by_build=True,
        columns="""
            DateKey INT NOT NULL,
            FullDateAlternateKey DATE NOT NULL,
            DayNumberOfWeek INT NOT NULL,
            EnglishDayNameOfWeek STRING NOT NULL,
            SpanishDayNameOfWeek STRING NOT NULL,
            FrenchDayNameOfWeek STRING NOT NULL,
            DayNumberOfMonth INT NOT NULL,
            DayNumberOfYear INT NOT NULL,
            WeekNumberOfYear INT NOT NULL,
            EnglishMonthName STRING NOT NULL,
            SpanishMonthName STRING NOT NULL,
            FrenchMonthName STRING NOT NULL,
            MonthNumberOfYear INT NOT NULL,
            CalendarQuarter INT NOT NULL,
            CalendarYear INT NOT NULL,
            CalendarSemester INT NOT NULL,
            FiscalQuarter INT NOT NULL,
            FiscalYear INT NOT NULL,
            FiscalSemester INT NOT NULL
        """,
    ),
    WarehouseTable(
        name="FactInternetSales",
        keys=("SalesOrderNumber", "SalesOrderLineNumber"),
        unique_by_build=True,
        sources=(
            "Product",
            "SalesOrderDetail",
            "SalesOrderHeader",
            "SalesTerritory",
            "CountryRegionCurrency",
        ),
        columns="""
            ProductKey BIGINT,
            OrderDateKey INT,
            DueDateKey INT,
            ShipDateKey INT,
            CustomerKey INT,
            PromotionKey BIGINT,
            CurrencyKey BIGINT,
            SalesTerritoryKey BIGINT,
            SalesOrderNumber STRING,
            SalesOrderLineNumber TINYINT,
            RevisionNumber TINYINT,
            OrderQuantity SMALLINT,
            UnitPrice DECIMAL(19,4),
            ExtendedAmount DECIMAL(19,4),
            UnitPriceDiscountPct FLOAT,
            DiscountAmount FLOAT,
            ProductStandardCost DECIMAL(19,4),
            TotalProductCost DECIMAL(19,4),
            SalesAmount DECIMAL(19,4),
            TaxAmt DECIMAL(19,4),
            Freight DECIMAL(19,4),
            CarrierTrackingNumber STRING,
            CustomerPONumber STRING,
            OrderDate TIMESTAMP,
            DueDate TIMESTAMP,
            ShipDate TIMESTAMP
        """,
    ),
    WarehouseTable(
        name="FactInternetSalesReason",
        keys=("SalesOrderNumber", "SalesOrderLineNumber", "SalesReasonKey"),
        unique_by_build=True,
        sources=("SalesOrderHeaderSalesReason",),
        columns="""
            SalesOrderNumber STRING NOT NULL,
            SalesOrderLineNumber TINYINT NOT NULL,
            SalesReasonKey INT NOT NULL
        """,
    ),
)
