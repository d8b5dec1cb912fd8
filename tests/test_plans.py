"""Plans that have to hold at scale."""

import pytest
from pyspark.sql import functions as F

from granary.operators.history import join_valid_version
from granary.operators.joins import left_join_many
from granary.queries import operators
from granary.session import scratch_root


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scans_read_only_what_they_need(spark, small):
    plan = plan_of(operators.merge_duplicate_source(spark, small))
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "l_linenumber" in schema and "l_comment" not in schema and "l_tax" not in schema


def test_filters_reach_the_scan(spark, small):
    finished = operators.table(spark, small, "orders").filter(F.col("o_orderstatus") == "F")
    plan = plan_of(operators._lines_with_version(spark, small, finished))
    assert "EqualTo(o_orderstatus,F)" in plan


def test_duplicates_and_counts_are_combined_before_the_shuffle(spark, small):
    assert "partial_count" in plan_of(operators.merge_duplicate_source(spark, small))
    assert "partial_sum" in plan_of(operators.merge_counts(spark, small))
    assert "partial_min_by" in plan_of(operators.pivot_first(spark, small))


def test_no_query_uses_a_cross_join(spark, small):
    for name, query in operators.OPERATOR_QUERIES.items():
        plan = plan_of(query(spark, small))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_version_join_keeps_its_key_without_broadcast(spark, small, no_broadcast):
    plan = plan_of(operators.scd_range_join(spark, small))
    assert "SortMergeJoin [l_partkey" in plan and "BroadcastHashJoin" not in plan


def test_a_hot_product_is_split(spark, no_broadcast):
    """One product in most lines: the skewed partition of the version join is split."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    lines = spark.range(0, 200000, 1, 16).selectExpr(
        "id", "if(id % 3 < 2, 7, id % 500) as fp", "date_add(date'2010-01-01', cast(id % 900 as int)) as at"
    )
    versions = spark.range(500).selectExpr(
        "id as p", "explode(array(0, 500)) as off"
    ).selectExpr(
        "p", "date_add(date'2010-01-01', off) as sd", "if(off = 0, date_add(date'2010-01-01', 499), null) as ed"
    )
    joined = join_valid_version(
        lines, versions, F.col("fp") == F.col("p"), F.col("at"), F.col("sd"), F.col("ed"), F.current_date()
    )
    result = joined.agg(F.count("*"), F.count("p"))
    assert result.collect() == [(200000, 200000)]
    assert "SortMergeJoin(skew=true)" in plan_of(result)
    for k, v in old.items():
        spark.conf.set(k, v)


def test_left_join_many(frame, rows):
    left = frame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    many = frame([(1, 10), (1, 11), (3, 30), (None, 0)], "k int, n int")
    joined = left_join_many(left, many, "k")
    assert rows(joined) == rows(left.join(many, "k", "left"))
    assert joined.columns == left.join(many, "k", "left").columns


def test_scratch_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_stored_lookups_decide_how_the_lines_join(spark, small, no_broadcast):
    """Below the threshold the lines are not shuffled on product or territory, above it they are."""
    from granary.plans import facts
    from granary.queries import layers

    gold = {n: layers.stored_lookup(n, spark, small) for n in facts.LOOKUPS}
    frames = layers.silver_frames(spark, small, facts.WAREHOUSE["FactInternetSales"].sources)
    placed = []
    real = facts.number_in_lanes
    facts.number_in_lanes = lambda df, *a: placed.append(df) or real(df, *a)
    try:
        for threshold, merges in (("10m", False), ("-1", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            facts.fact_internet_sales(frames, gold, layers.AS_OF)
            plan = plan_of(placed[-1])
            for key in ("ProductID", "TerritoryID"):
                assert (f"SortMergeJoin [{key}" in plan or f", {key}" in plan and "SortMergeJoin" in plan) == merges
                assert ("hashpartitioning(ProductID" in plan) == merges
    finally:
        facts.number_in_lanes = real


def test_lines_are_numbered_where_the_header_join_leaves_them(spark, small):
    """With lookups below the threshold and headers above it, joined lines are shuffled by order id only."""
    from granary.plans import facts
    from granary.queries import layers
    from granary.session import stored

    gold = {n: layers.stored_lookup(n, spark, small) for n in facts.LOOKUPS}
    frames = layers.silver_frames(spark, small, facts.WAREHOUSE["FactInternetSales"].sources)
    frames |= {n: stored(frames[n], n) for n in ("SalesOrderHeader", "SalesOrderDetail")}
    # Many headers and few lookups: the headers count for more than the threshold, whatever their files do.
    frames["SalesOrderHeader"] = frames["SalesOrderHeader"].hint("merge")
    plan = plan_of(facts.fact_internet_sales(frames, gold, layers.AS_OF))
    assert "rangepartitioning" not in plan and plan.count("Window") == 1
    assert plan.count("Exchange hashpartitioning(SalesOrderID") == plan.count("Exchange hashpartitioning") == 2


def test_silver_with_rejects_scans_once(spark, small):
    from granary.plans import silver
    from granary.queries import storefront
    from granary.registry import source

    table = source("SalesOrderHeader")
    checked = silver.check_rows(storefront.bronze_like(spark, small, table.full_name), table, "2002-01-01")
    plan = plan_of(checked)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_product_joins_go_by_rows_in_memory(spark, small):
    """Files far smaller than their rows are no reason to broadcast: products, histories and keys are sort-merged."""
    from granary.queries import layers

    plan = plan_of(layers.gold_dim_product(spark, small))
    # The small table of models and descriptions, and one row per partition of the new keys.
    assert plan.count("BroadcastExchange") == 2 and "_described" in plan
    assert plan.count("SortMergeJoin") >= 4


def test_descriptions_stay_out_of_the_join_for_surrogate_keys(spark, small):
    from granary.queries import layers

    plan = layers.gold_dim_product(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "_described" in joins[0] and "StartDate" in joins[1]


def test_the_planner_is_told_of_rows_that_outgrow_their_files(spark):
    from granary.operators.joins import by_measure, bytes_in_memory
    from granary.session import stored

    # 480,000 rows whose files are 10 KB or so, and text that is what it is.
    repeated = stored(spark.range(480000).selectExpr("1 as k", "2 as v"), "repeated")
    few = stored(spark.sql("select 1 as k, repeat('x', 1000) as v"), "few")
    assert bytes_in_memory(repeated) == 480000 * 24 and bytes_in_memory(few) == 1024
    lines = spark.range(100).selectExpr("id as k")
    assert "BroadcastHashJoin" in plan_of(lines.join(repeated, "k"))
    assert "BroadcastHashJoin" not in plan_of(lines.join(by_measure(repeated), "k"))
    assert "BroadcastHashJoin" in plan_of(lines.join(by_measure(few), "k"))


def test_lookups_of_the_lines_go_by_rows_in_memory(spark, small):
    """Product versions and headers whose files are below the threshold, and whose rows are not, are sort-merged."""
    from granary.operators.joins import by_measure
    from granary.plans import facts
    from granary.queries import layers
    from granary.session import stored

    gold = {n: layers.stored_lookup(n, spark, small) for n in facts.LOOKUPS}
    frames = layers.silver_frames(spark, small, facts.WAREHOUSE["FactInternetSales"].sources)
    frames |= {n: stored(frames[n], n) for n in ("SalesOrderHeader", "SalesOrderDetail")}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        frames["SalesOrderHeader"] = by_measure(frames["SalesOrderHeader"])
        plan = plan_of(facts.fact_internet_sales(frames, gold, layers.AS_OF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(ProductID" in plan and "hashpartitioning(SalesOrderID" in plan
    assert plan.count("BroadcastExchange") == 2  # promotions and territories
