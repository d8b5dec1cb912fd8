import pytest

from granary.operators import checks

RULES = {"positive": "n > 0", "short": "length(s) < 3"}


@pytest.fixture
def sample(frame):
    return frame(
        [(1, 5, "ab"), (2, -1, "ab"), (3, None, "ab"), (4, -1, "abc"), (5, None, "abc")],
        "k int, n int, s string",
    )


def keys(df):
    return sorted(r.k for r in df.collect())


def test_three_outcomes(sample):
    assert keys(checks.accept(sample, RULES)) == [1]
    # NULL AND FALSE is FALSE, so row 5 is rejected; row 3 is in neither set.
    assert keys(checks.reject_false(sample, RULES)) == [2, 4, 5]
    held = {r.k: r[checks.FAILED] for r in checks.quarantine(sample, RULES).collect()}
    assert held == {2: ["positive"], 3: ["positive"], 4: ["positive", "short"], 5: ["positive", "short"]}


def test_accepted_and_quarantined_are_everything(sample):
    both = keys(checks.accept(sample, RULES)) + keys(checks.quarantine(sample, RULES))
    assert sorted(both) == keys(sample)


def test_no_checks_accept_everything(sample):
    assert keys(checks.accept(sample, {})) == [1, 2, 3, 4, 5]
    assert keys(checks.quarantine(sample, {})) == []


def test_or_inside_a_check_stays_inside(frame):
    df = frame([(1, None, -1), (2, 5, 5)], "k int, a int, b int")
    rules = {"a": "a > 0 OR a IS NULL", "b": "b > 0"}
    assert keys(checks.accept(df, rules)) == [2]


def test_missing_required(sample, rows):
    assert rows(checks.missing_required(sample, ["k", "n"])) == [("k", 0), ("n", 2)]


def test_stored_checks(spark, tmp_path):
    name = "checks_table"
    spark.sql(f"CREATE TABLE {name} (n INT, s STRING) USING parquet LOCATION '{tmp_path}/t'")
    rules = {"in_list": "upper(s) IN ('A', 'B') OR s IS NULL", "positive": "n > 0"}
    assert checks.declare_checks(spark, name, rules) == ["in_list", "positive"]
    assert checks.declare_checks(spark, name, rules | {"new": "n < 9"}) == ["new"]
    assert checks.read_checks(spark, name) == rules | {"new": "n < 9"}
    spark.sql(f"DROP TABLE {name}")


def test_counts_per_check_with_examples(frame, rows):
    rules = {"a": "x > 0", "b": "y IS NOT NULL", "c": "true"}
    df = frame([(1, -1, 1), (2, None, None), (3, 5, 2), (None, 0, 1)], "k int, x int, y int")
    checked = df.withColumn(checks.FAILED, checks.failed_checks(rules))
    found = checks.check_counts(checked, list(rules), ["k"])
    assert rows(found) == [("a", 3, None, 2), ("b", 1, 2, 2), ("c", 0, None, None)]
    assert found.columns == ["check_name", "failed", "first_k", "last_k"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min" in plan
    none = checks.check_counts(checked.limit(0), list(rules), ["k"])
    assert {r.failed for r in none.collect()} == {0}
