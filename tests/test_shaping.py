import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.functions.calendar import DAY_NAMES, SPANISH, date_key, translated
from granary.functions.sales import order_id
from granary.operators import ordered
from granary.operators.shaping import number_lines, pivot_first
from granary.plans.dimensions import dim_date


def test_pivot_takes_the_first_by_order_and_keeps_absent_values(frame, rows):
    df = frame(
        [(1, "en  ", 2, "b"), (1, "en", 1, "a"), (1, "fr", 9, "z"), (2, "xx", 1, "q")],
        "m int, c string, id int, t string",
    )
    out = pivot_first(df, ["m"], F.trim("c"), {"en": "en", "fr": "fr", "th": "th"}, "t", "id")
    assert rows(out) == [(1, "a", "z", None), (2, None, None, None)]


def test_lines_are_numbered_within_their_order(frame, rows):
    df = frame([("A", 30), ("A", 10), ("B", 5), ("A", 20)], "o string, l int")
    out = number_lines(df, ["o"], ["l"], "n")
    assert rows(out) == [("A", 10, 1), ("A", 20, 2), ("A", 30, 3), ("B", 5, 1)]
    assert dict(out.dtypes)["n"] == "tinyint"


def test_127_lines_pass_and_128_raise(spark):
    lines = spark.range(128).selectExpr("'A' as o", "id as l")
    most = number_lines(lines.filter("l < 127"), ["o"], ["l"], "n")
    assert most.agg(F.max("n"), F.count("*")).first() == (127, 127)
    beyond = number_lines(lines, ["o"], ["l"], "n")
    with pytest.raises(PySparkException, match="OVERFLOW"):
        beyond.collect()
    # Without the number no row is lost either.
    assert beyond.count() == 128 and beyond.agg(F.sum("l")).first()[0] == 127 * 64


def test_a_large_group_is_numbered_across_partitions(spark, rows):
    lines = spark.range(4000).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 'hot', cast(id as string))) as o", "4000 - id as l"
    )
    plain = lines.withColumn("n", F.row_number().over(Window.partitionBy("o").orderBy("l")))
    split = ordered.number_rows(lines, ["o"], ["l"], "n")
    assert split.dtypes == plain.dtypes and rows(split) == rows(plain)


def test_a_group_of_several_lanes_is_numbered_on(spark, rows):
    lines = spark.range(3000).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 'hot', cast(id as string))) as o", "3000 - id as l", "id % 2 as i"
    ).withColumn("lane", F.floor(F.col("l") / 500))
    plain = lines.withColumn("n", F.row_number().over(Window.partitionBy("o").orderBy("l", "i")))
    spans = ordered.split_groups(lines, "o", F.col("lane"))
    assert rows(spans) == [("hot",), (None,)]
    few = lines.filter("o = 'hot' or o is null")
    for split in (None, few):
        made = ordered.number_in_lanes(lines, ["o"], ["lane"], ["l", "i"], "n", split)
        assert made.dtypes == plain.dtypes and rows(made) == rows(plain)
    none = ordered.number_in_lanes(lines.filter("l < 0"), ["o"], ["lane"], ["l"], "n")
    assert rows(none) == []


def test_clustered_rows_are_sorted_in_every_partition(spark):
    parts = ordered.cluster_rows(spark.range(1000).selectExpr("1000 - id as k"), ["k"])
    frames = parts.select("k", F.spark_partition_id().alias("p")).collect()
    assert [r.k for r in frames] == sorted(r.k for r in frames) and len(frames) == 1000


def test_order_number_is_parsed_or_null(frame, rows):
    df = frame([("SO43659",), ("SOxx",), (None,), ("SO12345678901",)], "s string")
    got = {r[0] for r in df.select(order_id(F.col("s"))).collect()}
    assert got == {43659, None, 12345678901}


def test_date_key_is_the_formatted_date(spark):
    days = spark.sql("select explode(sequence(date'1999-12-30', date'2000-03-02')) d")
    both = days.select(date_key(F.col("d")).alias("a"), F.date_format("d", "yyyyMMdd").cast("int").alias("b"))
    assert both.filter("a <> b").count() == 0


def test_calendar(spark):
    calendar = dim_date(spark)
    assert calendar.count() == 3652
    rows = {r.DateKey: r for r in calendar.collect()}
    first = rows[20050101]
    assert first.FullDateAlternateKey == dt.date(2005, 1, 1)
    assert (first.EnglishDayNameOfWeek, first.SpanishDayNameOfWeek, first.FrenchDayNameOfWeek) == (
        "Saturday", "Sábado", "Samedi",
    )
    assert (first.DayNumberOfWeek, first.WeekNumberOfYear, first.FrenchMonthName) == (7, 53, "Janvier")
    quarters = [(rows[d].CalendarQuarter, rows[d].FiscalQuarter, rows[d].FiscalYear, rows[d].FiscalSemester)
                for d in (20100115, 20100415, 20100715, 20101015)]
    assert quarters == [(1, 3, 2010, 2), (2, 4, 2010, 2), (3, 1, 2011, 1), (4, 2, 2010, 1)]


def test_unknown_name_gives_empty_text(frame):
    df = frame([("Someday",)], "d string")
    assert df.select(translated(F.col("d"), DAY_NAMES, SPANISH)).first()[0] == ""
