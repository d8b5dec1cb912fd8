import datetime as dt

from pyspark.sql import functions as F

from granary.operators.history import join_as_of, join_valid_version, match_open_ranges, overlapping_versions

def now():
    return F.lit("2020-01-01").cast("date")


def day(text):
    return dt.date.fromisoformat(text)


def versions(frame, *items):
    rows = [(p, v, day(a), day(b) if b else None) for p, v, a, b in items]
    return frame(rows, "p int, ver int, sd date, ed date")


def test_range_is_inclusive_and_open_version_ends_now(frame, rows):
    dims = versions(frame, (1, 1, "2010-01-01", "2010-12-31"), (1, 2, "2011-01-01", None))
    facts = frame(
        [(k, 1, day(d)) for k, d in enumerate(["2010-01-01", "2010-12-31", "2011-01-01", "2020-01-01"])]
        + [(7, 1, day("2021-01-01")), (8, 1, day("2009-01-01")), (9, 2, day("2010-05-05"))],
        "k int, fp int, at date",
    )
    joined = join_valid_version(
        facts, dims, F.col("fp") == F.col("p"), F.col("at"), F.col("sd"), F.col("ed"), now()
    )
    found = rows(joined.select("k", "ver"))
    assert found == [(0, 1), (1, 1), (2, 2), (3, 2), (7, None), (8, None), (9, None)]


def test_touching_versions_match_twice_and_are_reported(frame, rows):
    dims = versions(frame, (1, 1, "2010-01-01", "2011-01-01"), (1, 2, "2011-01-01", None))
    facts = frame([(1, 1, day("2011-01-01"))], "k int, fp int, at date")
    joined = join_valid_version(
        facts, dims, F.col("fp") == F.col("p"), F.col("at"), F.col("sd"), F.col("ed"), now()
    )
    assert rows(joined.select("ver")) == [(1,), (2,)]
    assert rows(overlapping_versions(dims, ["p"], "ver", "sd", "ed", now()).select("p", "ver")) == [(1, 2)]


def test_overlap_with_a_version_further_back(frame, rows):
    dims = versions(
        frame,
        (1, 1, "2010-01-01", "2015-01-01"),
        (1, 2, "2010-02-01", "2010-03-01"),
        (1, 3, "2014-01-01", None),
        (2, 1, "2010-01-01", "2010-02-01"),
        (2, 2, "2010-02-02", None),
    )
    found = rows(overlapping_versions(dims, ["p"], "ver", "sd", "ed", now()).select("p", "ver"))
    assert found == [(1, 2), (1, 3)]


def test_overlap_agrees_with_brute_force_for_one_hot_key(spark, rows):
    """One key holds most versions, so its running maximum crosses partitions."""
    dims = spark.range(3000).selectExpr(
        "cast(if(id % 10 = 0, id, 1) as int) p",
        "cast(id as int) ver",
        "date_add(date'2000-01-01', cast(pmod(hash(id), 4000) as int)) sd",
        "date_add(date'2000-01-01', cast(pmod(hash(id), 4000) + pmod(hash(id, 1), 9) as int)) ed",
    )
    found = rows(overlapping_versions(dims, ["p"], "ver", "sd", "ed", now()).select("p", "ver"))
    latest, expected = {}, []
    for r in sorted(dims.collect(), key=lambda r: (r.p, r.ver)):
        if r.p in latest and r.sd <= latest[r.p]:
            expected.append((r.p, r.ver))
        latest[r.p] = max(latest.get(r.p, r.ed), r.ed)
    assert found == sorted(expected, key=lambda r: [(False, str(v)) for v in r])


def test_open_ends_match_each_other(frame, rows):
    a = frame([(1, day("2010-01-01")), (2, None)], "k int, ed date").alias("a")
    b = frame([(1, day("2010-01-01")), (2, None), (3, None)], "k int, ed date").alias("b")
    on = (F.col("a.k") == F.col("b.k")) & match_open_ranges(F.col("a.ed"), F.col("b.ed"))
    assert rows(a.join(b, on).select("a.k")) == [(1,), (2,)]


def as_of(facts, dims):
    return join_as_of(facts, dims, [F.col("fp")], F.col("at"), ["p"], "sd", "ed", now())


def valid(facts, dims):
    return join_valid_version(facts, dims, F.col("fp") == F.col("p"), F.col("at"), F.col("sd"), F.col("ed"), now())


def test_as_of_join_equals_the_range_join(spark, rows):
    """Gaps, touching and overlapping versions, equal starts, repeated rows, NULL keys, times and ends."""
    dims = spark.range(400).selectExpr(
        "if(id % 37 = 0, null, cast(pmod(hash(id), 6) as int)) p",
        "cast(id as int) ver",
        "if(id % 41 = 0, null, date_add(date'2010-01-01', cast(pmod(hash(id, 1), 90) as int))) sd",
        "if(id % 11 = 0, null, date_add(date'2010-01-01', cast(pmod(hash(id, 1), 90) + pmod(hash(id, 2), 5) - 1 as int))) ed",
    )
    dims = dims.unionByName(dims.filter("ver % 50 = 3"))
    facts = spark.range(600).selectExpr(
        "id k", "if(id % 29 = 0, null, cast(pmod(hash(id), 8) as int)) fp",
        "if(id % 31 = 0, null, date_add(date'2009-12-30', cast(pmod(hash(id, 3), 99) as int))) at",
    )
    found = as_of(facts, dims)
    assert found.columns == valid(facts, dims).columns
    assert rows(found) == rows(valid(facts, dims)) and found.count() > 1000


def test_as_of_join_of_touching_versions_and_empty_sides(frame, rows):
    dims = versions(frame, (1, 1, "2010-01-01", "2011-01-01"), (1, 2, "2011-01-01", None))
    facts = frame([(1, 1, day("2011-01-01")), (2, 1, day("2010-06-01")), (3, 2, day("2010-06-01"))], "k int, fp int, at date")
    assert rows(as_of(facts, dims).select("k", "ver")) == [(1, 1), (1, 2), (2, 1), (3, None)]
    assert rows(as_of(facts, dims.limit(0)).select("k", "ver")) == [(1, None), (2, None), (3, None)]
    assert rows(as_of(facts.limit(0), dims).select("k", "ver")) == []


def rows_out_of_joins(df):
    """The most rows that any join of an executed plan returns."""
    most, open_nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            open_nodes.append(node.plan())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
        if "Join" in name and node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
    return most


def test_a_product_of_very_many_versions_makes_no_more_rows(spark):
    dims = spark.range(10000).selectExpr(
        "1 p", "cast(id as int) ver", "date_add(date'1990-01-01', cast(id as int)) sd",
        "date_add(date'1990-01-01', cast(id + id % 2 as int)) ed",
    )
    facts = spark.range(0, 20000, 1, 4).selectExpr("id k", "1 fp", "date_add(date'1990-01-01', cast(id % 10000 as int)) at")
    found = as_of(facts, dims)
    counted = found.groupBy("k").count().groupBy("count").count()
    assert {r[0]: r[1] for r in counted.collect()} == {1: 10002, 2: 9998}
    assert rows_out_of_joins(counted) == 29998
