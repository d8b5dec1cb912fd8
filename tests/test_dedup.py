from granary.operators.dedup import keep_latest, one_per_key


def test_latest_row_wins_and_null_comes_last(frame, rows):
    df = frame(
        [(1, 5, "old"), (1, 9, "new"), (1, None, "unknown"), (2, None, "only")], "k int, at int, v string"
    )
    assert rows(keep_latest(df, ["k"], "at")) == [(1, 9, "new"), (2, None, "only")]


def test_ties_fall_to_the_highest_tiebreak(frame, rows):
    df = frame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b")], "k int, at int, v string")
    assert rows(keep_latest(df, ["k"], "at", ["v"])) == [(1, 5, "c")]


def test_null_keys_form_one_group(frame, rows):
    df = frame([(None, 1), (None, 2), (3, 1)], "k int, at int")
    assert rows(keep_latest(df, ["k"], "at")) == [(3, 1), (None, 2)]


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as at")
    plan = keep_latest(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_one_per_key_keeps_the_lowest_row_whole(frame, rows):
    df = frame([("US", "USD", 3), ("US", "EUR", 7), ("DE", "EUR", 1)], "c string, cur string, n int")
    assert rows(one_per_key(df, ["c"], ["cur"])) == [("DE", "EUR", 1), ("US", "EUR", 7)]


def test_empty_input(frame, rows):
    df = frame([], "k int, at int")
    assert rows(keep_latest(df, ["k"], "at")) == []
    assert rows(one_per_key(df, ["k"], ["at"])) == []
