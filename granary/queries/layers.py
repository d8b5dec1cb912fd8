"""The silver and gold jobs over operational tables derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators.checks import FAILED, PROPERTY_PREFIX
from granary.operators.identity import assign_identity
from granary.operators.joins import by_measure
from granary.operators.sync import to_sink, to_sink_in_part
from granary.plans import dimensions, facts, silver
from granary.plans.pipeline import Warehouse, together
from granary.queries.storefront import bronze_like, changed, operational
from granary.registry import SOURCES, WAREHOUSE, source
from granary.session import scratch_path, stored
from granary.sources.landing import write_landing
from granary.sources.tables import VersionedTable

AS_OF = "2002-01-01 00:00:00"
MERGE_COUNTS = ("inserted", "updated", "deleted")

Query = Callable[[SparkSession, str], DataFrame]


def silver_job(name: str, spark: SparkSession, sf: str) -> DataFrame:
    cleaned = silver.clean(bronze_like(spark, sf, name), SOURCES[name], AS_OF, wide_ids=True)
    return cleaned.accepted


def quarantine_job(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """The rows a silver job holds back, whole, and the checks they fail."""
    cleaned = silver.clean(bronze_like(spark, sf, name), SOURCES[name], AS_OF, wide_ids=True)
    failed = F.concat_ws(",", FAILED).alias("failed")
    kept = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SOURCES[name].wide_struct]
    return cleaned.quarantined.select(*kept, failed)


def silver_frames(spark: SparkSession, sf: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {n: silver_job(source(n).full_name, spark, sf) for n in names}


def gold_dimension(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """A dimension as its first load would store it, surrogate keys included."""
    spec = WAREHOUSE[name]
    frames, schema = silver_frames(spark, sf, spec.sources), spec.schema_for(wide_ids=True)
    if name in dimensions.FINISHED:
        build, finish = dimensions.FINISHED[name]
        rows = to_sink_in_part(build(frames), schema)
        numbered = assign_identity(rows, None, spec.keys, spec.identity, null_safe=spec.null_safe_keys)[0]
        return to_sink(finish(numbered, frames), schema)
    rows = dimensions.DIMENSIONS[name](frames)
    if spec.identity is None:
        return to_sink(rows, schema)
    sink = to_sink(rows, schema, (spec.identity,))
    return assign_identity(sink, None, spec.keys, spec.identity, null_safe=spec.null_safe_keys)[0]


def stored_lookup(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """The columns of a dimension that the fact reads, stored and read back.

    From the files the planner knows the exact size, and so whether the lookup
    can be broadcast.
    """
    spec, columns = WAREHOUSE[name], facts.LOOKUPS[name]
    rows = dimensions.DIMENSIONS[name](silver_frames(spark, sf, spec.sources))
    schema = StructType(
        [f for f in spec.schema_for(wide_ids=True) if f.name in (spec.identity, *spec.keys, *columns)]
    )
    kept = VersionedTable(spark, scratch_path(spark, name))
    kept.sync(
        rows,
        spec.keys,
        schema,
        identity=spec.identity,
        null_safe=spec.null_safe_keys,
        keys_unique=spec.unique_by_build,
    )
    return kept.read()


def gold_dim_product(spark: SparkSession, sf: str) -> DataFrame:
    """DimProduct; the long description texts are shown by their digest."""
    rows = gold_dimension("DimProduct", spark, sf)
    texts = [f"{language}Description" for language in dimensions.CULTURES.values()]
    return rows.withColumns({c: F.md5(c) for c in texts})


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    spec = WAREHOUSE["FactInternetSales"]
    gold = dict(
        zip(facts.LOOKUPS, together(spark, [partial(stored_lookup, n, spark, sf) for n in facts.LOOKUPS]))
    )
    silver_tables = silver_frames(spark, sf, spec.sources)
    for name in ("SalesOrderHeader", "SalesOrderDetail"):  # stored, as a load has them
        silver_tables[name] = stored(silver_tables[name], name)
    silver_tables["SalesOrderHeader"] = by_measure(silver_tables["SalesOrderHeader"])
    return facts.fact_internet_sales(silver_tables, gold, AS_OF)


def gold_fact_internet_sales(spark: SparkSession, sf: str) -> DataFrame:
    return to_sink(_sales(spark, sf), WAREHOUSE["FactInternetSales"].schema_for(wide_ids=True))


def gold_fact_internet_sales_reason(spark: SparkSession, sf: str) -> DataFrame:
    spec = WAREHOUSE["FactInternetSalesReason"]
    frames = silver_frames(spark, sf, spec.sources)
    return to_sink(
        facts.fact_internet_sales_reason(_sales(spark, sf), frames), spec.schema_for(wide_ids=True)
    )


def _house(spark: SparkSession, label: str) -> Warehouse:
    """A warehouse in the scratch folder. Reports compare versions of gold tables only, so no others are kept."""
    root = scratch_path(spark, label)
    prefix = f"{root.rsplit('-', 1)[1]}_"
    kept = {"bronze": 1, "silver": 1}
    return Warehouse(spark, root, f"{root}/landing", prefix=prefix, as_of=AS_OF, wide_ids=True, retain_in=kept)


def _land_all(house: Warehouse, sf: str, rows_of: Callable[[SparkSession, str, str], DataFrame]) -> None:
    jobs = [partial(_land, house, name, partial(rows_of, house.spark, sf, name)) for name in SOURCES]
    together(house.spark, jobs)


def _land(house: Warehouse, name: str, rows: Callable[[], DataFrame]) -> str:
    return write_landing(rows(), house.landing, SOURCES[name])


def load_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Land all tables, load every layer twice, and compare the gold tables.

    Per gold table: its rows, the rows that the second load changed, and what
    the merge counted.
    """
    house = _house(spark, "warehouse")
    _land_all(house, sf, operational)
    house.run()
    house.run()
    reports = [_rerun_report(house, spec.name) for spec in WAREHOUSE.values()]
    report = stored(reduce(DataFrame.unionByName, reports), "report")
    house.drop_catalog()
    return report


# Columns of each gold table that the report of a changed load sums up.
CONTENT = {
    "DimDate": ("DateKey",),
    "DimCurrency": ("CurrencyKey", "CurrencyAlternateKey", "CurrencyName"),
    "DimPromotion": ("PromotionKey", "PromotionAlternateKey", "EnglishPromotionName", "MinQty"),
    "DimSalesReason": ("SalesReasonKey", "SalesReasonAlternateKey", "SalesReasonName"),
    "DimSalesTerritory": ("SalesTerritoryKey", "SalesTerritoryAlternateKey", "SalesTerritoryRegion"),
    "DimCustomer": ("CustomerKey", "CustomerAlternateKey", "FirstName", "Phone"),
    "DimProduct": ("ProductKey", "ProductAlternateKey", "Color", "Status"),
    "FactInternetSales": ("SalesOrderNumber", "SalesOrderLineNumber", "OrderQuantity", "CustomerKey"),
    "FactInternetSalesReason": ("SalesOrderNumber", "SalesOrderLineNumber", "SalesReasonKey"),
}


def _change_report(house: Warehouse, name: str) -> DataFrame:
    spec, kept = WAREHOUSE[name], house.gold(name)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in CONTENT[name]])
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    content = kept.read().agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(digest), F.lit(0)).alias("content"))
    counted = kept.changes(spec.keys, spec.null_safe_keys).select(*[F.col(c).cast("bigint") for c in MERGE_COUNTS])
    both = counted.select("*", F.lit(0).alias("n_rows"), F.lit(0).alias("content")).unionByName(
        content.select(*[F.lit(0).alias(c) for c in MERGE_COUNTS], "*")
    )
    sums = [F.sum(c).cast("bigint").alias(c) for c in both.columns]
    return both.agg(*sums).select(F.lit(name).alias("table_name"), "*")


def load_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Load every layer, change the source, load again: merge counts and content per gold table."""
    house = _house(spark, "changed")
    _land_all(house, sf, operational)
    house.run()
    _land_all(house, sf, changed)
    house.run()
    reports = [_change_report(house, name) for name in WAREHOUSE]
    report = stored(reduce(DataFrame.unionByName, reports), "report")
    house.drop_catalog()
    return report


def load_stored_check(spark: SparkSession, sf: str) -> DataFrame:
    """A check that is added to the stored table rejects rows on the next load."""
    house, table = _house(spark, "stored-check"), source("Customer")
    _land(house, table.full_name, partial(operational, spark, sf, table.full_name))
    house.load_bronze(table)
    house.load_silver(table)
    rule = f"'{PROPERTY_PREFIX}own_number' = 'CustomerID % 7 <> 0'"
    spark.sql(f"ALTER TABLE {house.silver(table).name} SET TBLPROPERTIES ({rule})")
    house.load_silver(table)
    kept = house.silver(table).read().select("CustomerID", F.lit("").alias("failed"))
    held = house.quarantine(table).read().select(
        F.col("CustomerID").cast("bigint"), F.concat_ws(",", F.sort_array(FAILED)).alias("failed")
    )
    report = stored(kept.unionByName(held), "report")
    house.drop_catalog()
    return report


def load_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Load bronze and silver of all tables that have checks, and report what each check has found."""
    house = _house(spark, "checks")
    tables = [source(t.name) for t in SOURCES.values() if t.checks]
    together(spark, [partial(_land, house, t.full_name, partial(operational, spark, sf, t.full_name)) for t in tables])
    together(spark, [partial(house.load_bronze, t) for t in tables])
    together(spark, [partial(house.load_silver, t) for t in tables])
    report = stored(house.check_report(), "report")
    house.drop_catalog()
    return report


def _rerun_report(house: Warehouse, name: str) -> DataFrame:
    spec, kept = WAREHOUSE[name], house.gold(name)
    first, second = kept.read(kept.version() - 1), kept.read()
    row = F.xxhash64(*second.columns).alias("row")
    signed = first.select(row, F.lit(-1).alias("n")).unionByName(second.select(row, F.lit(1).alias("n")))
    changed = signed.groupBy("row").agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum(F.abs("n")), F.lit(0)).alias("changed_rows")
    )
    counted = kept.changes(spec.keys, spec.null_safe_keys).select("*", F.lit(0).alias("changed_rows"))
    compared = changed.select(*[F.lit(0).alias(c) for c in counted.columns[:-1]], "changed_rows")
    totals = [F.sum(c).cast("bigint").alias(c) for c in counted.columns]
    return counted.unionByName(compared).agg(*totals).select(F.lit(name).alias("table_name"), "*")


def _snake(name: str) -> str:
    out = "".join(f"_{c.lower()}" if c.isupper() else c for c in name)
    return out.replace("__", "_").strip("_")


LAYER_QUERIES: dict[str, Query] = {
    **{f"silver_{_snake(n)}": partial(silver_job, n) for n in SOURCES},
    **{f"quarantine_{_snake(n)}": partial(quarantine_job, n) for n, t in SOURCES.items() if t.checks},
    **{
        f"gold_{_snake(n)}": partial(gold_dimension, n)
        for n in dimensions.DIMENSIONS
        if n != "DimProduct"
    },
    "gold_dim_product": gold_dim_product,
    "gold_fact_internet_sales": gold_fact_internet_sales,
    "gold_fact_internet_sales_reason": gold_fact_internet_sales_reason,
    "load_twice": load_twice,
    "load_changed": load_changed,
    "load_stored_check": load_stored_check,
    "load_checks": load_checks,
}
