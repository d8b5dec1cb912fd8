"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.functions.calendar import date_key
from granary.functions.sales import MONEY, discount_amount, order_id, sales_amount
from granary.functions.sales import account_number as sales_account
from granary.operators import checks, conform, dedup, fills, history, shaping, sync
from granary.operators.identity import assign_identity
from granary.operators.ordered import number_in_lanes, number_rows, split_groups
from granary.plans import facts
from granary.plans.dimensions import describe_days
from granary.queries.storefront import part_versions, table
from granary.registry import SourceTable
from granary.session import scratch_path, stored
from granary.sources.landing import read_landing, write_landing
from granary.sources.tables import VersionedTable

AS_OF = "2002-01-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines, latest ship date per order and line number."""
    return dedup.keep_latest(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        ["l_partkey", "l_suppkey"],
    )


# Keep one row per key


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


def dedup_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("value", F.nullif("value", F.lit(0.02)))
    latest = dedup.keep_latest(events, ["user_id", "event_type"], "value", ["event_id"])
    return latest.select("user_id", "event_type", "event_id", "value")


def dedup_load_time(spark: SparkSession, sf: str) -> DataFrame:
    latest = dedup.keep_latest(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "event_type")


def one_per_key(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_regionkey", "n_nationkey", "n_name")
    return dedup.one_per_key(nations, ["n_regionkey"], ["n_nationkey"])


# Fill and clean


def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
    )
    return fills.fill_constants(gaps, {"seg": "UNKNOWN", "bal": 0.0})


def fill_typed(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 12, F.col("c_acctbal") >= 0).alias("flag"),
        F.when(F.col("c_nationkey") > 8, F.lit("1999-01-01 00:00:00")).cast("timestamp").alias("ts"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("seg"),
    )
    filled = fills.fill_times(fills.fill_constants(gaps, {"flag": True}), ["ts"], as_of())
    return fills.trim_columns(filled, ["seg"])


def fill_row_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("rowguid"),
    )
    return fills.fill_row_id(rows, "orders", ["o_orderkey"])


def fill_row_id_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Row ids of a two-part text key with empty, missing and separator-like parts."""
    number = F.col("doc_id") % 4
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")), F.lit("|")).alias("a"),
        F.when(number == 1, "").when(number > 1, F.concat("source", F.lit("|"))).alias("b"),
        F.lit(None).cast("string").alias("rowguid"),
    )
    return fills.fill_row_id(rows, "documents", ["a", "b"]).select("doc_id", "rowguid")


def account_number(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", F.lit(None).cast("string").alias("acct"))
    return fills.fill_derived(rows, {"acct": (sales_account, "c_custkey")})


def _lines_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.when(F.col("l_linenumber") != 7, F.col("l_quantity"))
    return latest_lines(spark, sf).withColumn("qty", quantity)


def guarded_total(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines_with_gaps(spark, sf).withColumn("lt", F.col("l_extendedprice"))
    guarded = fills.guard_totals(lines, {"lt": "qty * l_extendedprice * (1.0 - l_discount)"})
    return guarded.select("l_orderkey", "l_linenumber", "lt")


# Checks

LINE_CHECKS = {"quantity": "qty >= 0", "ship_date": "l_shipdate >= o_orderdate"}


def _lines_to_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = _lines_with_gaps(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "qty", "l_shipdate", "o_orderdate")


def checks_accept(spark: SparkSession, sf: str) -> DataFrame:
    return checks.accept(_lines_to_check(spark, sf), LINE_CHECKS)


def checks_reject_false(spark: SparkSession, sf: str) -> DataFrame:
    return checks.reject_false(_lines_to_check(spark, sf), LINE_CHECKS)


def checks_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    held = checks.quarantine(_lines_to_check(spark, sf), LINE_CHECKS)
    names = F.concat_ws(",", checks.FAILED).alias("failed")
    return held.select("l_orderkey", "l_linenumber", "qty", "l_shipdate", "o_orderdate", names)


def checks_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that fail each check, with the first and last key; no row fails the last one."""
    rules = LINE_CHECKS | {"order_date": "o_orderdate IS NOT NULL"}
    checked = _lines_to_check(spark, sf).withColumn(checks.FAILED, checks.failed_checks(rules))
    return checks.check_counts(checked, list(rules), ["l_orderkey", "l_linenumber"])


def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "lineitem").select(
        F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
    )
    return checks.missing_required(gaps, ["l_quantity", "l_discount"])


# Schemas


def cast_to_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_totalprice").alias("t"),
        F.col("o_orderdate").alias("d"),
        F.substring("o_orderpriority", 1, 1).alias("p"),
        F.col("o_orderstatus").alias("dropped"),
    )
    return conform.cast_to(rows, StructType.fromDDL("k BIGINT, t DECIMAL(19,4), d DATE, p TINYINT"))


def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    expected = "o_orderkey INT, o_custkey BIGINT, o_totalprice DECIMAL(19,4), o_orderstatus STRING"
    orders = table(spark, sf, "orders").drop("o_orderdate")
    return conform.schema_report(orders, StructType.fromDDL(expected))


# Merge


def _earlier_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers the target holds: BUILDING has not come in yet."""
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nm"))


def _later_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers the source holds: overdrawn ones are gone, names have changed."""
    customers = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return customers.select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("*")).alias("nm"))


def merge_identity(spark: SparkSession, sf: str) -> DataFrame:
    schema = StructType.fromDDL("k BIGINT, id BIGINT, nm STRING")
    target = VersionedTable(spark, scratch_path(spark, "merge_identity"))
    target.sync(_earlier_customers(spark, sf), ["id"], schema, identity="k")
    target.sync(_later_customers(spark, sf), ["id"], schema, identity="k")
    return target.read()


def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sync.sync_counts(_later_customers(spark, sf), _earlier_customers(spark, sf), ["id"])


def _feed_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and after: some new, some gone, some with another price or a priority that went missing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    key = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey")).alias("k")  # some keys have a NULL part
    rows = orders.select(key, F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("p"),
                         F.col("o_orderpriority").alias("q"), F.col("o_orderkey").alias("n"))
    price = F.when(F.col("n") % 5 == 0, F.col("p") + 1).otherwise(F.col("p"))
    missing = F.when(F.col("n") % 7 != 0, F.col("q"))
    return rows.filter("n % 13 <> 0"), rows.filter("n % 17 <> 0").withColumns({"p": price, "q": missing})


def merge_feed(spark: SparkSession, sf: str) -> DataFrame:
    """What a load inserted, changed and deleted, from the digests kept beside two versions."""
    old, new = _feed_tables(spark, sf)
    target = VersionedTable(spark, scratch_path(spark, "merge_feed"))
    target.publish(old)
    target.publish(new)
    return target.feed(["k", "n"]).withColumnRenamed(sync.CHANGE, "change")


def merge_feed_applied(spark: SparkSession, sf: str) -> DataFrame:
    """The old version with the feed applied, keys matched null-safely: the new version."""
    old, new = _feed_tables(spark, sf)
    feed = sync.change_feed(new, old, ["k", "n"], null_safe=True)
    return sync.apply_feed(old, stored(feed, "feed"), ["k", "n"])


def merge_feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that a load left as they were, changed, inserted and deleted, of repeated and NULL keys too."""
    old, new = _feed_tables(spark, sf)
    keys = ["c", "k"]
    changes = sync.key_changes(sync.row_digests(new, keys), sync.row_digests(old, keys), keys)
    return changes.groupBy(F.col(sync.CHANGE).alias("change")).agg(F.sum("rows").alias("n"))


def _suppliers_by_nullable_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") >= 1000, F.col("s_suppkey")).alias("k"),
        F.col("s_name").alias("n"),
        "s_nationkey",
    )


def merge_null_safe_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a NULL key part keep their surrogate key over three loads."""
    suppliers = _suppliers_by_nullable_key(spark, sf)
    schema = StructType.fromDDL("id BIGINT, k BIGINT, n STRING, s_nationkey INT")
    target = VersionedTable(spark, scratch_path(spark, "merge_null_safe"))
    for left_out in (1, 2, 2):
        rows = suppliers.filter(F.col("s_nationkey") != left_out)
        target.sync(rows, ["k", "n"], schema, identity="id", null_safe=True)
    return target.read()


def merge_null_safe_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = _suppliers_by_nullable_key(spark, sf)
    return sync.duplicate_keys(suppliers, ["k", "s_nationkey"], null_safe=True)


def merge_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = _suppliers_by_nullable_key(spark, sf)
    target = suppliers.filter(F.col("s_nationkey") != 1)
    source = suppliers.filter(F.col("s_nationkey") != 2)
    plain = sync.sync_counts(source, target, ["k", "n"])
    safe = sync.sync_counts(source, target, ["k", "n"], null_safe=True)
    return plain.select(F.lit("plain").alias("m"), "*").unionByName(
        safe.select(F.lit("null_safe").alias("m"), "*")
    )


def merge_duplicate_source(spark: SparkSession, sf: str) -> DataFrame:
    return sync.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


ORDERS = SourceTable(schema="Shop", name="Orders", keys=("o_orderkey",), columns="o_orderkey BIGINT")


def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    """Land and load all orders, then land and load again without low-priority ones."""
    landing, bronze = scratch_path(spark, "landing"), VersionedTable(spark, scratch_path(spark, "bronze"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    for rows in (orders, orders.filter(F.col("o_orderpriority") != "5-LOW")):
        write_landing(rows, landing, ORDERS)
        bronze.sync_evolving(read_landing(spark, landing, ORDERS, as_of()), ORDERS.keys)
    return bronze.read().select(
        "o_orderkey",
        "o_orderpriority",
        "_process_timestamp",
        F.col("_input_file_name").endswith(".parquet").alias("from_file"),
    )


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Second load brings a new column and lacks an old one."""
    bronze = VersionedTable(spark, scratch_path(spark, "evolution"))
    orders = table(spark, sf, "orders")
    bronze.sync_evolving(orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderkey"])
    bronze.sync_evolving(orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), ["o_orderkey"])
    return bronze.read()


# Dimensions


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar from the first to the last order year, with the orders of each day."""
    per_day = table(spark, sf, "orders").groupBy(date_key(F.col("o_orderdate")).alias("DateKey")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    years = table(spark, sf, "orders").agg(
        F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")
    )
    days = years.select(
        F.explode(F.sequence(F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31))))
        .alias("day")
    )
    return describe_days(days).join(per_day, "DateKey", "left").fillna(0, ["orders"])


def dim_territory(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    columns = {"a": "n_nationkey", "b": "n_name", "c": "r_name", "d": conform.typed_null("string")}
    return shaping.project(joined, columns)


def dim_promotion(spark: SparkSession, sf: str) -> DataFrame:
    percent = F.round(F.col("l_discount") * 100).cast("int")
    offers = table(spark, sf, "lineitem").select("l_discount").distinct()
    named = shaping.project(
        offers,
        {
            "ak": percent,
            "nm": F.concat(F.lit("Discount "), percent.cast("string")),
            "es": conform.typed_null("string"),
        },
    )
    return assign_identity(named, None, ["ak"], "k")[0]


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    first_order = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("fd")
    )
    joined = (
        table(spark, sf, "customer")
        .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    account = sales_account(F.col("c_custkey"))
    return shaping.project(
        joined,
        {
            "k": "c_custkey",
            "ak": account,
            "c_name": "c_name",
            "n_name": "n_name",
            "r_name": "r_name",
            "fd": "fd",
            "x": conform.typed_null("string"),
        },
    )


def _sizes_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.pivot_first(
        table(spark, sf, "documents"),
        ["source"],
        F.col("lang"),
        {"en": "en", "fr": "fr", "de": "de", "es": "es"},
        "n_chars",
        "doc_id",
    )


def pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes_by_source(spark, sf)


def strip_names(spark: SparkSession, sf: str) -> DataFrame:
    """Padded pivot columns get clean names."""
    counts = table(spark, sf, "documents").groupBy("source").agg(
        *[F.count_if(F.col("lang") == code.strip()).alias(code) for code in ("en    ", " fr", " de ", "es ")]
    )
    return conform.strip_column_names(counts)


def history_join(spark: SparkSession, sf: str) -> DataFrame:
    versions = part_versions(spark, sf)
    cost, price = versions.alias("a"), versions.filter(F.col("ver") != 2).alias("b")
    same_period = (
        (F.col("a.p_partkey") == F.col("b.p_partkey"))
        & (F.col("a.sd") == F.col("b.sd"))
        & history.match_open_ranges(F.col("a.ed"), F.col("b.ed"))
    )
    return cost.join(price, same_period, "left").select(
        F.col("a.p_partkey").alias("pid"), "a.sd", "a.ed", "a.cost", F.col("b.cost").alias("lp")
    )


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    part, versions = table(spark, sf, "part").alias("p"), part_versions(spark, sf).alias("v")
    sizes = _sizes_by_source(spark, sf).withColumn("sid", F.substring("source", 4, 9).cast("int"))
    joined = part.join(sizes.alias("d"), F.col("p.p_size") == F.col("d.sid"), "left").join(
        versions, F.col("p.p_partkey") == F.col("v.p_partkey"), "left"
    )
    return shaping.project(
        joined,
        {
            "pn": F.concat(F.lit("PN-"), F.col("p.p_partkey").cast("string")),
            "p_name": "p.p_name",
            "cost": "v.cost",
            "sd": "v.sd",
            "ed": "v.ed",
            "st": F.when(F.col("v.ed").isNull(), "Current"),
            "en": "d.en",
            "fr": "d.fr",
            "de": "d.de",
            "es_chars": "d.es",
        },
    )


# Versioned dimension


def _lines_with_version(spark: SparkSession, sf: str, orders: DataFrame) -> DataFrame:
    lines = latest_lines(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    dated = lines.withColumn("ordered", F.col("o_orderdate").cast("timestamp"))
    return history.join_valid_version(
        dated,
        part_versions(spark, sf),
        F.col("l_partkey") == F.col("p_partkey"),
        F.col("ordered"),
        F.col("sd"),
        F.col("ed"),
        as_of(),
    )


def scd_range_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = _lines_with_version(spark, sf, table(spark, sf, "orders"))
    return joined.select("l_orderkey", "l_linenumber", F.col("p_partkey").alias("pid"), "ver", "cost")


def scd_as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the daily version of their part: one version a day, ends inclusive, some of two days."""
    lines = latest_lines(spark, sf).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    # A part has a version for each day on which it was ordered; those of even days last a day longer.
    days = lines.select(F.col("l_partkey").alias("part"), F.to_date("o_orderdate").alias("day")).distinct()
    longer = F.when(F.dayofmonth("day") % 2 == 0, F.date_add("day", 1)).otherwise(F.col("day"))
    open_end = F.when(F.col("part") % 10 != 0, longer)
    daily = days.select("part", F.col("day").alias("sd"), open_end.alias("ed"))
    dated = lines.withColumn("ordered", F.to_date("o_orderdate"))
    joined = history.join_as_of(
        dated, daily, [F.col("l_partkey")], F.col("ordered"), ["part"], "sd", "ed", as_of().cast("date")
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "ordered", "sd", "ed")


def version_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Versions that touch the one before; the first version of small parts ends late."""
    late = F.when((F.col("ver") == 1) & (F.col("p_size") < 20), F.lit("1997-05-30 00:00:00")).cast("timestamp")
    versions = part_versions(spark, sf).withColumn("ed", F.coalesce(late, F.col("ed")))
    found = history.overlapping_versions(versions, ["p_partkey"], "ver", "sd", "ed", as_of())
    return found.select("p_partkey", "ver", "sd", "earlier_end")


# Facts


def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    lines = _lines_with_version(spark, sf, finished)
    price, discount = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast(MONEY)
    quantity = F.col("l_quantity").cast("smallint")
    named = shaping.project(
        lines,
        {
            "son": F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")),
            "odk": date_key(F.col("ordered")),
            "pk": "ver",
            "qty": quantity,
            "ext": price,
            "da": discount_amount(discount, price).cast("decimal(38,8)"),
            "sa": sales_amount(price, discount, price),
            "tpc": (quantity * F.col("cost")).cast(MONEY),
            "order": "l_orderkey",
            "lane": F.floor(F.col("l_linenumber") / facts.LANE),
            "line": "l_linenumber",
        },
    )
    lane = F.floor(F.col("l_linenumber") / facts.LANE)
    long = split_groups(table(spark, sf, "lineitem"), "l_orderkey", lane).withColumnRenamed("l_orderkey", "order")
    split = named.join(stored(long, "long-orders"), "order", "left_semi")
    numbered = number_in_lanes(named, ["son"], ["order", "lane"], ["line", "pk"], "ln", split)
    return numbered.drop("order", "lane", "line")


def number_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events numbered per user, groups of any size."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    return number_rows(events, ["user_id"], ["ts", "event_id"], "n")


def fact_sales_reason(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons of each line, found through the number in the order number."""
    lines = fact_sales(spark, sf).select("son", "ln", order_id(F.col("son")).alias("o_orderkey"))
    bridge = table(spark, sf, "orders").filter(F.col("o_orderpriority") < "4").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rk")
    )
    return lines.join(bridge, "o_orderkey").select("son", "ln", "rk")


def _stored(rows: DataFrame, key: str, ddl: str) -> DataFrame:
    """A keyed lookup in a table of its own; its first column is the surrogate key."""
    spark, schema = rows.sparkSession, StructType.fromDDL(ddl)
    kept = VersionedTable(spark, scratch_path(spark, "lookup"))
    kept.sync(rows, [key], schema, identity=schema.names[0], keys_unique=True)
    return kept.read()


def fact_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the surrogate keys of part, promotion, territory and currency."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    offers = table(spark, sf, "lineitem").select(F.col("l_discount").alias("d")).distinct()
    promotions = _stored(offers, "d", "promo BIGINT, d DOUBLE")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", "n_regionkey", F.col("r_name").alias("rname")
    )
    territories = _stored(
        named, "n_nationkey", "terr BIGINT, n_nationkey INT, n_regionkey INT, rname STRING"
    )
    currencies = _stored(nation.select(F.col("n_nationkey").alias("nk")), "nk", "curr BIGINT, nk INT")
    by_region = dedup.one_per_key(
        nation.select("n_regionkey", F.col("n_nationkey").alias("nk")), ["n_regionkey"], ["nk"]
    )
    places = (
        territories.join(by_region, "n_regionkey", "left")
        .join(currencies, "nk", "left")
        .select("n_nationkey", "terr", "rname", "curr")
    )
    return (
        latest_lines(spark, sf)
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(promotions, F.col("l_discount") == F.col("d"), "left")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("l_orderkey", "l_linenumber", "p_partkey", "promo", "terr", "rname", "curr")
    )


OPERATOR_QUERIES = {
    f.__name__: f
    for f in (
        dedup_latest,
        dedup_nulls_last,
        dedup_load_time,
        one_per_key,
        fill_defaults,
        fill_typed,
        fill_row_id,
        fill_row_id_composite,
        account_number,
        guarded_total,
        checks_accept,
        checks_reject_false,
        checks_quarantine,
        checks_counts,
        required_columns,
        cast_to_schema,
        schema_report,
        merge_identity,
        merge_counts,
        merge_feed,
        merge_feed_applied,
        merge_feed_counts,
        merge_null_keys,
        merge_null_safe_identity,
        merge_null_safe_duplicates,
        merge_duplicate_source,
        bronze_load,
        schema_evolution,
        dim_date,
        dim_territory,
        dim_promotion,
        dim_customer,
        pivot_first,
        strip_names,
        history_join,
        dim_product,
        scd_range_join,
        scd_as_of_join,
        version_overlap,
        fact_sales,
        number_events,
        fact_lookups,
        fact_sales_reason,
    )
}
