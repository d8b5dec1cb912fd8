import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql.types import StructType

from granary.operators import conform


def schema(ddl):
    return StructType.fromDDL(ddl)


def test_cast_selects_orders_and_drops(frame):
    df = frame([("7", 1.5, "x")], "b string, a double, extra string")
    out = conform.cast_to(df, schema("a DECIMAL(19,4), b INT"))
    assert out.columns == ["a", "b"]
    assert conform.schema_differences(out.schema, schema("a DECIMAL(19,4), b INT")) == []


def test_missing_column_raises(frame):
    with pytest.raises(ValueError, match="missing.*c"):
        conform.cast_to(frame([(1,)], "a int"), schema("a INT, c INT"))


def test_values_that_do_not_fit_raise(frame):
    with pytest.raises(ArithmeticException):
        conform.cast_to(frame([(300,)], "a int"), schema("a TINYINT")).collect()
    with pytest.raises(NumberFormatException):
        conform.cast_to(frame([("x",)], "a string"), schema("a INT")).collect()


def test_differences_ignore_nullability_and_missing_columns(frame):
    df = frame([(1, 2.0, "x")], "a int, b double, extra string")
    found = conform.schema_differences(df.schema, schema("a INT NOT NULL, b FLOAT, absent INT"))
    assert [(d.column, d.problem) for d in found] == [("b", "different type"), ("extra", "not expected")]
    with pytest.raises(ValueError, match="b: different type.*extra: not expected"):
        conform.verify_schema(df, schema("a INT, b FLOAT"))


def test_report_counts_the_values_touched(frame, rows):
    df = frame([(1, 2.0), (2, None)], "a int, b double")
    report = rows(conform.schema_report(df, schema("a INT, b FLOAT")))
    assert report == [("b", "different type", "double", "float", 1)]
    assert rows(conform.schema_report(df, schema("a INT, b DOUBLE"))) == []


def test_strip_column_names(frame):
    assert conform.strip_column_names(frame([(1, 2)], "`en   ` int, ` fr` int")).columns == ["en", "fr"]
