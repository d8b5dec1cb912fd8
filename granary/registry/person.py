"""Operational tables of the Person schema.

Fixed values: names, types, keys, defaults and check texts are the data
contract of the source system.
"""

from granary.registry.base import SourceTable

PERSON_TABLES = (
    SourceTable(
        schema="Person",
        name="Address",
        keys=("AddressID",),
        columns="""
            AddressID INT NOT NULL,
            AddressLine1 STRING NOT NULL,
            AddressLine2 STRING,
            City STRING NOT NULL,
            StateProvinceID INT NOT NULL,
            PostalCode STRING NOT NULL,
            SpatialLocation STRING NOT NULL
        """,
        row_id="",
        modified="",
        # The spatial column has no Parquet type, so the extract reads it as text.
        extract_query=(
            "SELECT AddressID, AddressLine1, AddressLine2, City, StateProvinceID, PostalCode, "
            "CAST(SpatialLocation AS VARCHAR(MAX)) AS SpatialLocation, rowguid, ModifiedDate "
            "FROM Person.Address"
        ),
    ),
    SourceTable(
        schema="Person",
        name="EmailAddress",
        keys=("EmailAddressID",),
        columns="""
            BusinessEntityID INT NOT NULL,
            EmailAddressID INT NOT NULL,
            EmailAddress STRING
        """,
        row_id="NOT NULL",
    ),
    SourceTable(
        schema="Person",
        name="PersonPhone",
        keys=("BusinessEntityID", "PhoneNumber", "PhoneNumberTypeID"),
        columns="""
            BusinessEntityID INT NOT NULL,
            PhoneNumber STRING NOT NULL,
            PhoneNumberTypeID INT NOT NULL
        """,
    ),
    SourceTable(
        schema="Person",
        name="StateProvince",
        keys=("StateProvinceID",),
        columns="""
            StateProvinceID INT NOT NULL,
            StateProvinceCode STRING NOT NULL,
            CountryRegionCode STRING NOT NULL,
            IsOnlyStateProvinceFlag BOOLEAN NOT NULL,
            Name STRING NOT NULL,
            TerritoryID INT NOT NULL
        """,
        row_id="NOT NULL",
        constants={"IsOnlyStateProvinceFlag": True},
    ),
    SourceTable(
        schema="Person",
        name="CountryRegion",
        keys=("CountryRegionCode",),
        columns="""
            CountryRegionCode STRING NOT NULL,
            Name STRING NOT NULL
        """,
    ),
    SourceTable(
        schema="Person",
        name="Person",
        keys=("BusinessEntityID",),
        columns="""
            BusinessEntityID INT NOT NULL,
            PersonType STRING NOT NULL,
            NameStyle BOOLEAN NOT NULL,
            Title STRING,
            FirstName STRING NOT NULL,
            MiddleName STRING,
            LastName STRING NOT NULL,
            Suffix STRING,
            EmailPromotion INT NOT NULL,
            AdditionalContactInfo STRING,
            Demographics STRING
        """,
        row_id="NOT NULL",
        constants={"NameStyle": False, "EmailPromotion": 0},
        checks={
            "CK_Person_EmailPromotion": "EmailPromotion >= 0 AND EmailPromotion <= 2",
            "CK_Person_PersonType": (
                "upper(PersonType) IN ('SP', 'GC', 'EM', 'IN', 'VC', 'SC') OR PersonType IS NULL"
            ),
        },
    ),
    SourceTable(
        schema="Person",
        name="BusinessEntityAddress",
        # One address is kept per entity: the key leaves out the address id.
        keys=("BusinessEntityID",),
        columns="""
            BusinessEntityID INT NOT NULL,
            AddressID INT NOT NULL,
            AddressTypeID INT NOT NULL
        """,
        row_id="NOT NULL",
    ),
)
