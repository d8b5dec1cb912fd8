import datetime as dt
import uuid
from decimal import Decimal

from granary.functions.sales import account_number
from granary.operators import fills


def test_constants_keep_the_column_type(frame):
    df = frame(
        [(1, None, None, None), (2, 3, Decimal("4.5000"), False)],
        "k int, b tinyint, d decimal(19,4), f boolean",
    )
    filled = fills.fill_constants(df, {"b": 0, "d": 0, "f": True})
    assert filled.dtypes == df.dtypes
    assert filled.orderBy("k").collect() == [(1, 0, Decimal(0), True), (2, 3, Decimal("4.5"), False)]


def test_times_are_filled_with_the_run_time(frame):
    known = dt.datetime(2020, 1, 2)
    df = frame([(1, None), (2, known)], "k int, t timestamp")
    filled = fills.fill_times(df, ["t"], "2002-01-01 00:00:00").orderBy("k").collect()
    assert [r.t for r in filled] == [dt.datetime(2002, 1, 1), known]


def test_row_ids_are_stable_distinct_and_kept(frame):
    df = frame([(1, 1, None), (1, 2, None), (2, 1, "mine")], "a int, b int, rowguid string")
    first = [r.rowguid for r in fills.fill_row_id(df, "t", ["a", "b"]).orderBy("a", "b").collect()]
    again = [r.rowguid for r in fills.fill_row_id(df, "t", ["a", "b"]).orderBy("a", "b").collect()]
    assert first == again and len(set(first)) == 3 and first[2] == "mine"
    assert str(uuid.UUID(first[0])) == first[0]


def test_derived_value_fills_gaps_only(frame, rows):
    df = frame([(7, None), (123456789, None), (3, "AC3")], "CustomerID int, AccountNumber string")
    filled = fills.fill_derived(df, {"AccountNumber": (account_number, "CustomerID")})
    assert rows(filled) == [(123456789, "AW23456789"), (3, "AC3"), (7, "AW00000007")]


def test_guard_zeroes_incomplete_totals_and_recomputes_nothing(frame, rows):
    df = frame(
        [(1, Decimal(2), Decimal(99)), (2, None, Decimal(99)), (3, Decimal(1), None)],
        "k int, part decimal(19,4), total decimal(19,4)",
    )
    guarded = fills.guard_totals(df, {"total": "part + part"})
    assert guarded.dtypes == df.dtypes
    assert [(k, t) for k, _, t in rows(guarded)] == [(1, Decimal(99)), (2, Decimal(0)), (3, None)]


def test_trim(frame, rows):
    assert rows(fills.trim_columns(frame([(" r ",), (None,)], "c string"), ["c"])) == [("r",), (None,)]


def test_different_keys_never_share_a_row_id(frame):
    parts = [None, "", "|", "-", "1:", "a|", "|a", "1:a"]
    df = frame([(a, b, None) for a in parts for b in parts], "a string, b string, rowguid string")
    assert fills.fill_row_id(df, "t", ["a", "b"]).select("rowguid").distinct().count() == len(parts) ** 2
