"""Landing, the extract options, and the whole load on derived tables."""

import datetime as dt
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.operators.checks import read_checks
from granary.plans.pipeline import Warehouse
from granary.queries.storefront import unique_rows
from granary.registry import SOURCES, WAREHOUSE, SourceTable, source
from granary.sources.landing import (
    boundary_query,
    extract_query,
    jdbc_options,
    range_predicates,
    read_landing,
    write_landing,
)
from granary.sources.tables import RuleViolation, table_ddl


def test_extract_queries():
    assert extract_query(source("Currency")) == "SELECT * FROM Sales.Currency"
    assert "CAST(SpatialLocation AS VARCHAR(MAX))" in extract_query(source("Address"))


def test_extract_options():
    whole = jdbc_options(source("Currency"), {"url": "jdbc:x"})
    assert whole["query"] == "SELECT * FROM Sales.Currency" and "dbtable" not in whole
    split = jdbc_options(source("Customer"), {"url": "jdbc:x"}, "CustomerID", (1, 900), 16)
    assert split["dbtable"] == "(SELECT * FROM Sales.Customer) extract" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "CustomerID", "1", "900", "16",
    )


KEYS = st.tuples(st.sampled_from(["a", "A", "b'c", "ba", "", "é"]), st.integers(-3, 3) | st.just(1 << 40), st.dates(
    dt.date(2020, 1, 1), dt.date(2020, 1, 4)))


@settings(max_examples=40, deadline=None)
@given(rows=st.lists(KEYS, max_size=60), nulls=st.integers(0, 3), parts=st.integers(1, 9), width=st.integers(1, 3))
def test_extract_ranges_are_disjoint_and_complete(rows, nulls, parts, width):
    """The database is one that only this process sees; keys repeat, are text, dates, composite and sparse."""
    table = SourceTable(schema="main", name="t", keys=("s", "n", "d")[:width], columns="s STRING, n BIGINT, d DATE")
    db = duckdb.connect()
    db.execute("CREATE TABLE t (s VARCHAR, n BIGINT, d DATE)")
    for row in [*rows, *[(None, 1, None)] * nulls]:
        db.execute("INSERT INTO t VALUES (?, ?, ?)", row)
    starts = db.execute(boundary_query(table, table.keys, parts)).fetchall()
    assert len(starts) <= max(0, parts - 1)
    counts = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates(table.keys, starts)]
    assert sum(counts) == len(rows) + nulls and counts[-1] == nulls
    most = max(Counter(r[:width] for r in rows).values(), default=0)
    assert all(c <= len(rows) / parts + 1 + most for c in counts[:-1])


def test_parts_of_a_skewed_key_have_equal_sizes():
    table = SourceTable(schema="main", name="t", keys=("s", "n"), columns="s STRING, n BIGINT")
    db = duckdb.connect()
    db.execute("CREATE TABLE t AS SELECT CASE WHEN i % 3 > 0 THEN 'hot' ELSE 'k' || i % 7 END s, i * i * i n FROM range(9000) r(i)")
    starts = db.execute(boundary_query(table, table.keys, 16)).fetchall()
    counts = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates(table.keys, starts)]
    assert len(counts) == 17 and counts[-1] == 0 and max(counts) <= min(counts[:-1]) + 1


def test_ranges_in_the_database_are_the_ranges_in_spark(spark):
    """The conditions are plain SQL: Spark reads the same parts."""
    spark.range(500).selectExpr("concat('k', id % 9) s", "id n").createOrReplaceTempView("ranges_here")
    parts = range_predicates(["s", "n"], [("k1", 400), ("k5", 3), ("k5", 3), ("k8", 499)])
    found = [spark.sql(f"SELECT * FROM ranges_here WHERE {p}").count() for p in parts]
    assert len(found) == 5 and sum(found) == 500 and found[-1] == 0


def test_landing_round_trip_with_files_that_differ(spark, tmp_path, frame):
    table = source("Currency")
    path = write_landing(frame([("EUR", "Euro")], "CurrencyCode string, Name string"), str(tmp_path), table)
    frame([("USD", 2)], "CurrencyCode string, Digits int").write.mode("append").parquet(path)
    landed = read_landing(spark, str(tmp_path), table, "2002-01-01 00:00:00", merge_schema=True)
    assert set(landed.columns) == {"CurrencyCode", "Name", "Digits", "_process_timestamp", "_input_file_name"}
    assert landed.filter("_input_file_name like '%Sales/Currency%.parquet'").count() == 2


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    built = Warehouse(
        spark, root, f"{root}/landing", prefix="house_", as_of="2002-01-01 00:00:00", wide_ids=True
    )
    for name, spec in SOURCES.items():
        write_landing(unique_rows(spark, "/root/testdata/sf0.001", name), built.landing, spec)
    built.run()
    return built


def test_every_table_is_loaded_and_registered(spark, house):
    for spec in SOURCES.values():
        assert spark.table(f"house_silver.{spec.full_name}").schema.names == spec.struct.names
        assert house.bronze(spec).exists()
    for name in WAREHOUSE:
        assert spark.table(f"house_gold.{name}").count() == house.gold(name).notes()["rows"] > 0


def test_the_load_notes_what_each_check_found(spark, house):
    report = {(r.table_name, r.check_name): r for r in house.check_report().collect()}
    assert set(report) == {(t.full_name, c) for t in SOURCES.values() for c in t.checks}
    for name, spec in SOURCES.items():
        if spec.checks:
            of = [r for (t, _), r in report.items() if t == name]
            assert {r.accepted for r in of} == {house.silver(spec).read().count()}
            assert all(r.checked == r.accepted + r.quarantined and r.failed <= r.quarantined for r in of)


def test_table_ddl_declares_required_columns_and_defaults(spark, house):
    header = source("SalesOrderHeader")
    text = table_ddl(header.struct, header.defaults)
    assert "`SalesOrderID` int NOT NULL," in text and "`ShipDate` timestamp," in text
    assert "`Status` tinyint NOT NULL DEFAULT 1" in text
    # The catalog keeps types and defaults; Parquet tables do not keep NOT NULL.
    stored = spark.sql("SHOW CREATE TABLE house_silver.Sales_SalesOrderHeader").first()[0]
    assert "SalesOrderID BIGINT" in stored and "Status TINYINT DEFAULT 1" in stored


def test_checks_are_stored_with_the_table(spark, house):
    header = source("SalesOrderHeader")
    assert read_checks(spark, f"house_silver.{header.full_name}") == dict(header.checks)


def test_nothing_is_lost_between_silver_and_quarantine(house):
    for name in ("SalesOrderHeader", "SalesOrderDetail", "Product", "Person", "Customer"):
        spec = source(name)
        kept, held = house.silver(spec).read(), house.quarantine(spec).read()
        assert held.count() > 0 or name == "Product"
        assert kept.count() + held.count() == house.bronze(spec).read().count()


def test_second_run_changes_nothing(house, rows):
    before = {n: rows(house.gold(n).read()) for n in WAREHOUSE}
    house.run()
    for name, old in before.items():
        assert rows(house.gold(name).read()) == old, name


def test_rows_gone_from_the_source_go_everywhere(spark, house):
    currency = source("Currency")
    kept = house.gold("DimCurrency").read()
    old = {r.CurrencyAlternateKey: r.CurrencyKey for r in kept.collect()}
    landed = spark.read.parquet(f"{house.landing}/Sales/Currency").filter("CurrencyCode <> 'AFR'").collect()
    write_landing(spark.createDataFrame(landed), house.landing, currency)
    house.load_bronze(currency)
    house.load_silver(currency)
    house.load_dimension("DimCurrency")
    new = {r.CurrencyAlternateKey: r.CurrencyKey for r in house.gold("DimCurrency").read().collect()}
    assert new == {c: k for c, k in old.items() if c != "AFR"} and len(new) == len(old) - 1


def test_a_country_that_does_not_exist_stops_the_territory_load(spark, house):
    country = source("CountryRegion")
    landed = spark.read.parquet(f"{house.landing}/Person/CountryRegion").filter("CountryRegionCode <> 'AS'")
    write_landing(spark.createDataFrame(landed.collect()), house.landing, country)
    house.load_bronze(country)
    house.load_silver(country)
    version = house.gold("DimSalesTerritory").version()
    with pytest.raises(RuleViolation, match="SalesTerritoryCountry"):
        house.load_dimension("DimSalesTerritory")
    assert house.gold("DimSalesTerritory").version() == version


def test_empty_tables_load(spark, tmp_path, frame):
    empty = Warehouse(spark, str(tmp_path), f"{tmp_path}/landing", prefix="empty_", as_of="2002-01-01 00:00:00")
    for name in ("Sales_Currency", "Sales_SpecialOffer"):
        rows = unique_rows(spark, "/root/testdata/sf0.001", name)
        write_landing(rows.limit(0), empty.landing, SOURCES[name])
        empty.load_bronze(SOURCES[name])
        empty.load_silver(SOURCES[name])
        assert empty.silver(SOURCES[name]).read().count() == 0
    empty.load_dimension("DimPromotion")
    assert empty.gold("DimPromotion").notes()["highest"] == 0
