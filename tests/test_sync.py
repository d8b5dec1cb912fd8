import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators import identity
from granary.operators.identity import assign_identity
from granary.operators.sync import (
    CHANGE,
    align_columns,
    apply_feed,
    change_feed,
    duplicate_keys,
    key_changes,
    row_digests,
    sync_counts,
    to_sink,
)
from granary.sources import files
from granary.sources.tables import RuleViolation, TableNotFound, VersionedTable, create_layers

KEYED = StructType().add("sk", "long").add("k", "integer").add("v", "string")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, f"{tmp_path}/t")


def test_sync_updates_inserts_deletes_and_keeps_identities(table, frame, rows):
    table.sync(frame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert rows(table.read()) == [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]
    table.sync(frame([(3, "C"), (4, "d"), (0, "z")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert rows(table.read()) == [(3, 3, "C"), (4, 0, "z"), (5, 4, "d")]
    assert table.changes(["k"]).first() == (2, 1, 2)


def test_a_deleted_identity_is_not_given_out_again(table, frame, rows):
    table.sync(frame([(1, "a"), (2, "b")], "k int, v string"), ["k"], KEYED, identity="sk")
    table.sync(frame([(1, "a")], "k int, v string"), ["k"], KEYED, identity="sk")
    table.sync(frame([(1, "a"), (9, "n")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert rows(table.read()) == [(1, 1, "a"), (3, 9, "n")]


def test_null_keys_match_only_when_asked(table, frame, rows):
    schema = StructType.fromDDL("sk BIGINT, k INT, d INT")
    source = frame([(1, None), (1, 5)], "k int, d int")
    table.sync(source, ["k", "d"], schema, identity="sk", null_safe=True)
    first = rows(table.read())
    table.sync(source, ["k", "d"], schema, identity="sk", null_safe=True)
    assert rows(table.read()) == first
    table.sync(source, ["k", "d"], schema, identity="sk", null_safe=False)
    assert {r.sk for r in table.read().filter("d is null").collect()} == {3}


def test_empty_source_and_empty_target(table, frame, rows):
    empty = frame([], "k int, v string")
    table.sync(empty, ["k"], KEYED, identity="sk")
    assert rows(table.read()) == []
    table.sync(frame([(1, "a")], "k int, v string"), ["k"], KEYED, identity="sk")
    table.sync(empty, ["k"], KEYED, identity="sk")
    assert rows(table.read()) == []
    assert table.changes(["k"]).first() == (0, 0, 1)


def test_repeated_source_key_raises_and_leaves_the_table(table, frame, rows):
    table.sync(frame([(1, "a")], "k int, v string"), ["k"], KEYED, identity="sk")
    with pytest.raises(RuleViolation, match="repeat"):
        table.sync(frame([(2, "x"), (2, "y")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert rows(table.read()) == [(1, 1, "a")]
    table.sync(frame([(2, "x")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert rows(table.read()) == [(2, 2, "x")]


def test_missing_required_value_raises_and_leaves_the_table(table, frame, rows):
    schema = StructType.fromDDL("k INT NOT NULL, v STRING NOT NULL")
    table.sync(frame([(1, "a")], "k int, v string"), ["k"], schema, required=["k", "v"])
    with pytest.raises(RuleViolation, match="'v': 1"):
        table.sync(frame([(2, None)], "k int, v string"), ["k"], schema, required=["k", "v"])
    assert rows(table.read()) == [(1, "a")]


def test_reading_before_the_first_load_raises(table):
    with pytest.raises(TableNotFound):
        table.read()


def test_sink_projection(frame):
    out = to_sink(frame([(1, "x", 9)], "k int, v string, extra int"), KEYED, ("sk",))
    assert out.columns == ["k", "v"]
    with pytest.raises(ValueError, match="v"):
        to_sink(frame([(1,)], "k int"), KEYED, ("sk",))


def test_new_and_missing_columns(table, frame, rows):
    table.sync_evolving(frame([(1, "a"), (1, "again")], "k int, v string"), ["k"])
    assert table.read().count() == 2
    table.sync_evolving(frame([(1, 7)], "k int, n int"), ["k"])
    assert table.read().columns == ["k", "v", "n"] and rows(table.read()) == [(1, None, 7)]
    with pytest.raises(RuleViolation):
        table.sync_evolving(frame([(1, 7), (1, 8)], "k int, n int"), ["k"], unique=True)
    table.sync_evolving(frame([(1, 7), (1, 8)], "k bigint, n int"), ["k"])
    assert rows(table.read()) == [(1, None, 7), (1, None, 8)] and dict(table.read().dtypes)["k"] == "int"
    with pytest.raises(PySparkException):
        table.sync_evolving(frame([(1 << 40, 7)], "k bigint, n int"), ["k"])
    known = StructType.fromDDL("k INT, gone TINYINT")
    assert align_columns(frame([(1, 2)], "n int, k int"), known).dtypes == [
        ("k", "int"), ("gone", "tinyint"), ("n", "int"),
    ]


def test_duplicates_ignore_incomplete_keys(frame, rows):
    df = frame([(1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(duplicate_keys(df, ["a", "b"], null_safe=True)) == [(1, 1, 2), (1, None, 2)]


def test_null_safe_keys_stay_and_repeats_are_refused(table, frame, rows):
    schema, keys = StructType.fromDDL("sk BIGINT, k STRING, d INT, v INT"), ["k", "d"]
    batch = [("a", None, 1), ("a", 1, 2), (None, None, 3)]
    for v in (0, 10, 20):
        new = frame([(k, d, n + v) for k, d, n in batch], "k string, d int, v int")
        table.sync(new, keys, schema, identity="sk", null_safe=True)
        assert rows(table.read().select("sk", "k", "d")) == [(1, None, None), (2, "a", None), (3, "a", 1)]
    with pytest.raises(RuleViolation, match="repeat"):
        table.sync(frame([("a", None, 1), ("a", None, 2)], "k string, d int, v int"), keys, schema, "sk", True)
    assert table.read().count() == 3


def test_only_key_columns_of_new_rows_are_placed(table, frame, rows, monkeypatch):
    placed = []
    real = identity.place_in_order
    monkeypatch.setattr(identity, "place_in_order", lambda df, *a, **k: placed.append(df.columns) or real(df, *a, **k))
    table.sync(frame([(1, "x"), (2, "y")], "k int, v string"), ["k"], KEYED, identity="sk")
    table.sync(frame([(1, "z"), (2, "y")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert placed == [["k"]]
    table.sync(frame([(1, "z"), (None, "n"), (None, "m"), (3, "w")], "k int, v string"), ["k"], KEYED, identity="sk")
    assert [r[0] for r in rows(table.read().orderBy("sk"))] == [1, 3, 4, 5]


def test_catalog_entry_follows_the_versions(spark, tmp_path, frame, rows):
    create_layers(spark, str(tmp_path), "cat_")
    table = VersionedTable(spark, f"{tmp_path}/bronze/t", "cat_bronze.t")
    table.publish(frame([(1, "a")], "k int, v string"), defaults={"k": "0"})
    assert rows(spark.table("cat_bronze.t")) == [(1, "a")]
    table.publish(frame([(2, "b")], "k int, v string"))
    assert rows(spark.table("cat_bronze.t")) == [(2, "b")]
    table.publish(frame([(2, "b", 1)], "k int, v string, n int"))
    assert rows(spark.table("cat_bronze.t")) == [(2, "b", 1)]
    # A new session finds the current version from the files alone.
    assert VersionedTable(spark, table.path).version() == 2


def test_identities_are_dense_and_ordered_across_partitions(spark):
    source = spark.range(5000).selectExpr("cast(4999 - id as int) k")
    keyed, highest = assign_identity(source.repartition(7), None, ["k"], "sk", 100)
    assert highest == 5100
    assert keyed.filter(F.col("sk") != F.col("k") + 101).count() == 0


keys = st.lists(st.tuples(st.integers(0, 8), st.text("ab", max_size=2)), max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=keys, second=keys)
def test_after_a_sync_the_target_is_the_source(spark, tmp_path_factory, frame, rows, first, second):
    table = VersionedTable(spark, str(tmp_path_factory.mktemp("sync")))
    for batch in (first, second):
        table.sync(frame(batch, "k int, v string"), ["k"], KEYED, identity="sk")
    stored = table.read()
    assert rows(stored.select("k", "v")) == rows(frame(second, "k int, v string"))
    identities = [r.sk for r in stored.collect()]
    assert len(set(identities)) == len(identities)
    counts = table.changes(["k"]).first()
    before, after = {k for k, _ in first}, {k for k, _ in second}
    assert tuple(counts) == (len(after - before), len(after & before), len(before - after))


def test_counts_handle_a_key_shared_by_most_rows(spark):
    source = spark.range(300).selectExpr("if(id % 3 = 0, null, id) as k")
    target = spark.range(150).selectExpr("if(id % 3 = 0, null, id) as k")
    assert sync_counts(source, target, ["k"]).first() == (200, 100, 50)
    assert sync_counts(source, target, ["k"], null_safe=True).first() == (100, 100 + 100 * 50, 0)


def test_files_are_laid_out_and_old_versions_go(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", retain=2, cluster=("k",))
    for n in (3000, 2000, 1000):
        table.publish(spark.range(n).selectExpr(f"cast({n} - 1 - id as int) k").repartition(5))
    assert table.versions() == [1, 2] and table.read(1).count() == 2000
    read = table.read().select("k", F.input_file_name().alias("f")).groupBy("f").agg(F.min("k"), F.max("k")).collect()
    ranges = sorted((low, high) for _, low, high in read)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_scratch_of_a_load_is_removed(spark):
    from granary.session import scratch_scope, stored

    with scratch_scope(spark):
        kept = stored(spark.range(5), "kept")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert files.exists(spark, path)
    assert not files.exists(spark, path)


CELLS = st.lists(st.tuples(st.integers(0, 5) | st.none(), st.sampled_from(["a", "b"]) | st.none(), st.integers(0, 1) | st.none()),
                 max_size=9, unique_by=lambda r: r[:2])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=CELLS, new=CELLS, null_safe=st.booleans())
def test_a_feed_applied_to_the_old_version_gives_the_new_one(spark, frame, rows, old, new, null_safe):
    ddl = "k int, s string, v int"
    before, after = frame(old, ddl), frame(new, ddl)
    feed = change_feed(after, before, ["k", "s"], null_safe)
    assert rows(apply_feed(before, feed, ["k", "s"])) == rows(after)
    known = {r[:2]: r for r in old if null_safe or None not in r[:2]}
    kinds = sorted(r[CHANGE] for r in feed.collect())
    there = [r[:2] in known for r in new]
    changed = [r for r, t in zip(new, there) if t and known[r[:2]] != r]
    gone = len(old) - sum(there)
    assert kinds == ["changed"] * len(changed) + ["deleted"] * gone + ["inserted"] * (len(new) - sum(there))


def test_digests_tell_nulls_from_values(frame):
    one, two = frame([(1, None, 2)], "k int, a int, b int"), frame([(1, 2, None)], "k int, a int, b int")
    assert [r[CHANGE] for r in change_feed(one, two, ["k"]).collect()] == ["changed"]


def test_kept_digests_serve_the_feed_and_go_with_their_version(spark, tmp_path, frame, rows):
    table = VersionedTable(spark, f"{tmp_path}/t", retain=2)
    with pytest.raises(TableNotFound):
        table.feed(["k"])
    table.publish(frame([(1, "a"), (2, "b"), (None, "n")], "k int, v string"))
    assert rows(table.feed(["k"])) == [(1, "a", "inserted"), (2, "b", "inserted"), (None, "n", "inserted")]
    table.publish(frame([(1, "a"), (2, "c"), (None, "n")], "k int, v string"))
    assert rows(table.feed(["k"])) == [(2, "c", "changed"), (None, "n", "inserted"), (None, None, "deleted")]
    assert rows(table.feed(["k"], null_safe=True)) == [(2, "c", "changed")]
    kept = {r[CHANGE]: r.rows for r in table.key_changes(["k"], null_safe=True).groupBy(CHANGE).agg(F.sum("rows").alias("rows")).collect()}
    assert kept == {"unchanged": 2, "changed": 1}
    assert sorted(n for n in files.child_names(spark, table.path) if n.startswith("digests")) == ["digests-0-k", "digests-1-k"]
    table.publish(frame([(3, "d")], "k int, v string"))
    assert [n for n in files.child_names(spark, table.path) if n.startswith("digests")] == ["digests-1-k"]


def test_a_key_that_most_rows_share_is_one_row_of_the_comparison(spark):
    old = spark.range(400).selectExpr("if(id % 3 = 0, null, 1) k", "id v")
    new = spark.range(401).selectExpr("if(id % 3 = 0, null, 1) k", "id v")
    changes = key_changes(row_digests(new, ["k"]), row_digests(old, ["k"]), ["k"])
    assert sorted((r.k or 0, r[CHANGE], r.rows) for r in changes.collect()) == [
        (0, "deleted", 134), (0, "inserted", 134), (1, "changed", 267)]
    assert "partial_bit_xor" in changes._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_a_load_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    import time

    from granary.plans.pipeline import Warehouse

    house = Warehouse(spark, f"{tmp_path}/house", f"{tmp_path}/landing", prefix="shuffled_")
    rows = spark.range(1000).selectExpr("id % 7 as k").repartition(5).groupBy("k").count()
    monkeypatch.setattr(house, "_run", lambda: VersionedTable(spark, f"{tmp_path}/t").publish(rows))
    before, key = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    house.run()
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(key, None) == setting
    house._run()
    assert shuffle_files(spark) - before


def test_versions_are_kept_by_layer(spark, tmp_path):
    from granary.plans.pipeline import Warehouse
    from granary.queries import layers
    from granary.registry import source

    house = Warehouse(spark, f"{tmp_path}/house", f"{tmp_path}/landing", prefix="kept_", retain=3, retain_in={"silver": 1})
    table = source("Currency")
    assert [house.bronze(table).retain, house.silver(table).retain, house.gold("DimCurrency").retain] == [3, 1, 3]
    own = layers._house(spark, "kept")
    assert [own.bronze(table).retain, own.quarantine(table).retain, own.gold("DimCurrency").retain] == [1, 1, None]
