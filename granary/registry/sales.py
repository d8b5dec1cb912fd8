"""Operational tables of the Sales schema.

Fixed values: names, types, keys, defaults and check texts are the data
contract of the source system.
"""

from granary.functions.sales import account_number
from granary.registry.base import SourceTable

SALES_TABLES = (
    SourceTable(
        schema="Sales",
        name="SalesOrderHeader",
        keys=("SalesOrderID",),
        columns="""
            SalesOrderID INT NOT NULL,
            RevisionNumber TINYINT NOT NULL,
            OrderDate TIMESTAMP NOT NULL,
            DueDate TIMESTAMP NOT NULL,
            ShipDate TIMESTAMP,
            Status TINYINT NOT NULL,
            OnlineOrderFlag BOOLEAN NOT NULL,
            SalesOrderNumber STRING,
            PurchaseOrderNumber STRING,
            AccountNumber STRING,
            CustomerID INT NOT NULL,
            SalesPersonID INT,
            TerritoryID INT,
            BillToAddressID INT NOT NULL,
            ShipToAddressID INT NOT NULL,
            ShipMethodID INT NOT NULL,
            CreditCardID INT,
            CreditCardApprovalCode STRING,
            CurrencyRateID INT,
            SubTotal DECIMAL(19,4) NOT NULL,
            TaxAmt DECIMAL(19,4) NOT NULL,
            Freight DECIMAL(19,4) NOT NULL,
            TotalDue DECIMAL(19,4),
            Comment STRING
        """,
        row_id="",
        constants={
            "RevisionNumber": 0,
            "SubTotal": 0,
            "TaxAmt": 0,
            "Freight": 0,
            "Status": 1,
            "OnlineOrderFlag": True,
        },
        stamps=("OrderDate",),
        guarded={"TotalDue": "SubTotal + TaxAmt + Freight"},
        checks={
            "CK_SalesOrderHeader_DueDate": "DueDate >= OrderDate",
            "CK_SalesOrderHeader_Freight": "Freight >= 0.00",
            "CK_SalesOrderHeader_ShipDate": "ShipDate >= OrderDate OR ShipDate IS NULL",
            "CK_SalesOrderHeader_Status": "Status >= 0 AND Status <= 8",
            "CK_SalesOrderHeader_SubTotal": "SubTotal >= 0.00",
            "CK_SalesOrderHeader_TaxAmt": "TaxAmt >= 0.00",
        },
    ),
    SourceTable(
        schema="Sales",
        name="SalesOrderDetail",
        keys=("SalesOrderID", "SalesOrderDetailID"),
        columns="""
            SalesOrderID INT NOT NULL,
            SalesOrderDetailID INT NOT NULL,
            CarrierTrackingNumber STRING,
            OrderQty SMALLINT NOT NULL,
            ProductID INT NOT NULL,
            SpecialOfferID INT NOT NULL,
            UnitPrice DECIMAL(19,4) NOT NULL,
            UnitPriceDiscount DECIMAL(19,4) NOT NULL,
            LineTotal DECIMAL(19,4)
        """,
        row_id="NOT NULL",
        constants={"UnitPriceDiscount": 0},
        guarded={"LineTotal": "UnitPrice * (1.0 - UnitPriceDiscount) * OrderQty"},
        checks={
            "CK_SalesOrderDetail_OrderQty": "OrderQty >= 0",
            "CK_SalesOrderDetail_UnitPrice": "UnitPrice >= 0.00",
            "CK_SalesOrderDetail_UnitPriceDiscount": "UnitPriceDiscount >= 0.00",
        },
    ),
    SourceTable(
        schema="Sales",
        name="Customer",
        keys=("CustomerID",),
        columns="""
            CustomerID INT NOT NULL,
            PersonID INT NOT NULL,
            StoreID INT,
            TerritoryID INT,
            AccountNumber STRING
        """,
        row_id="NOT NULL",
        derived={"AccountNumber": (account_number, "CustomerID")},
        checks={"CK_Customer_PersonID": "PersonID IS NOT NULL"},
    ),
    SourceTable(
        schema="Sales",
        name="SpecialOffer",
        keys=("SpecialOfferID",),
        columns="""
            SpecialOfferID INT NOT NULL,
            Description STRING NOT NULL,
            DiscountPct DECIMAL(10,4) NOT NULL,
            Type STRING NOT NULL,
            Category STRING NOT NULL,
            StartDate TIMESTAMP NOT NULL,
            EndDate TIMESTAMP NOT NULL,
            MinQty INT NOT NULL,
            MaxQty INT
        """,
        row_id="NOT NULL",
        constants={"DiscountPct": 0, "MinQty": 0},
        checks={
            "CK_SpecialOffer_DiscountPct": "DiscountPct >= 0.00",
            "CK_SpecialOffer_EndDate": "EndDate >= StartDate",
            "CK_SpecialOffer_MaxQty": "MaxQty >= 0 OR MaxQty IS NULL",
            "CK_SpecialOffer_MinQty": "MinQty >= 0",
        },
    ),
    SourceTable(
        schema="Sales",
        name="Currency",
        keys=("CurrencyCode",),
        columns="""
            CurrencyCode STRING NOT NULL,
            Name STRING NOT NULL
        """,
    ),
    SourceTable(
        schema="Sales",
        name="SalesTerritory",
        keys=("TerritoryID",),
        columns="""
            TerritoryID INT NOT NULL,
            Name STRING NOT NULL,
            CountryRegionCode STRING NOT NULL,
            `Group` STRING NOT NULL,
            SalesYTD DECIMAL(19,4) NOT NULL,
            SalesLastYear DECIMAL(19,4) NOT NULL,
            CostYTD DECIMAL(19,4) NOT NULL,
            CostLastYear DECIMAL(19,4) NOT NULL
        """,
        row_id="NOT NULL",
        constants={"SalesYTD": 0, "SalesLastYear": 0, "CostYTD": 0, "CostLastYear": 0},
        checks={
            "CK_SalesTerritory_CostLastYear": "CostLastYear >= 0.00",
            "CK_SalesTerritory_CostYTD": "CostYTD >= 0.00",
            "CK_SalesTerritory_SalesLastYear": "SalesLastYear >= 0.00",
            "CK_SalesTerritory_SalesYTD": "SalesYTD >= 0.00",
        },
    ),
    SourceTable(
        schema="Sales",
        name="SalesReason",
        keys=("SalesReasonID",),
        columns="""
            SalesReasonID INT NOT NULL,
            Name STRING NOT NULL,
            ReasonType STRING NOT NULL
        """,
    ),
    SourceTable(
        schema="Sales",
        name="vPersonDemographics",
        keys=("BusinessEntityID",),
        columns="""
            BusinessEntityID INT NOT NULL,
            TotalPurchaseYTD DECIMAL(19,4) NOT NULL,
            DateFirstPurchase TIMESTAMP NOT NULL,
            BirthDate TIMESTAMP NOT NULL,
            MaritalStatus STRING NOT NULL,
            YearlyIncome STRING NOT NULL,
            Gender STRING NOT NULL,
            TotalChildren INT NOT NULL,
            NumberChildrenAtHome INT NOT NULL,
            Education STRING NOT NULL,
            Occupation STRING NOT NULL,
            HomeOwnerFlag BOOLEAN NOT NULL,
            NumberCarsOwned INT NOT NULL
        """,
        modified=None,
        # Every business column has to be present, one named check each.
        checks={
            f"CK_vPersonDemographics_{column}": f"{column} IS NOT NULL"
            for column in (
                "BusinessEntityID",
                "TotalPurchaseYTD",
                "DateFirstPurchase",
                "BirthDate",
                "MaritalStatus",
                "YearlyIncome",
                "Gender",
                "TotalChildren",
                "NumberChildrenAtHome",
                "Education",
                "Occupation",
                "HomeOwnerFlag",
                "NumberCarsOwned",
            )
        },
    ),
    SourceTable(
        schema="Sales",
        name="CountryRegionCurrency",
        keys=("CountryRegionCode", "CurrencyCode"),
        columns="""
            CountryRegionCode STRING NOT NULL,
            CurrencyCode STRING NOT NULL
        """,
    ),
    SourceTable(
        schema="Sales",
        name="SalesOrderHeaderSalesReason",
        keys=("SalesOrderID", "SalesReasonID"),
        columns="""
            SalesOrderID INT NOT NULL,
            SalesReasonID INT NOT NULL
        """,
    ),
)
