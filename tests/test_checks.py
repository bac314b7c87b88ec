"""All checks of a table from one scan: the same numbers as check by check."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quantloom.operators import checks as Q
from quantloom.plans import registry, table_checks

SCHEMA = "k int, g string, day date, v double, s string, tags array<int>"


def table(spark):
    d = lambda i: date(2024, 1, i)
    rows = [
        (1, "a", d(1), 1.0, "x", [1]), (2, "a", d(2), float("nan"), "y1", [1, 2]), (3, "a", d(8), -1.0, None, None),
        (3, "a", d(8), None, "y2", []), (None, "b", d(5), float("inf"), "z", [1]), (None, "b", d(5), 2.0, "z", [1]), (9, "b", d(7), 3.0, "", [1]), (8, "c", None, 4.0, "x", [3]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def every_check(spark):
    known = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y2"), (3, "w")], "k int, s string")
    as_of = F.lit("2024-01-20").cast("date")
    return {
        "not_empty": Q.not_empty(), "not_null": Q.not_null("k", "v"), "length": Q.list_length("tags", 1), "range": Q.in_range("v", 0, 2.5), "late": Q.freshness("day", 3, as_of), "fresh": Q.freshness("day", 30, as_of),
        "accepted": Q.accepted_values("s", ["x", "y1"]), "rejected": Q.rejected_values("s", ["z"]), "compare": Q.comparison("v", "<", F.col("k")), "finite": Q.finite("v"), "matches": Q.matches("s", "y[0-9]"), "negative": Q.no_negative("v"),
        "known": Q.foreign_key(["k"], known), "both": Q.foreign_key(["s", "k"], known, ["s", "k"]), "unique": Q.unique("g", "day"), "unique k": Q.unique("k"), "gaps": Q.no_gaps("day", ["g"]), "own": lambda df: df.where("k = 3"),
    }


def test_report_counts_what_each_check_finds(spark):
    df, checks = table(spark), every_check(spark)
    got = {r.check: r.violations for r in Q.report(df, checks).collect()}
    expected = {k: c(df).count() for k, c in checks.items()} | {"not_null": 3}  # rows, where the check gives one row that counts them
    assert got == expected and got["gaps"] == 6 and got["unique"] == 4 and got["known"] == 4
    empty = {r.check: r.violations for r in Q.report(df.limit(0), checks).collect()}
    assert empty.pop("not_empty") == 1 and set(empty.values()) == {0}


def test_weekday_gaps_in_the_shared_scan(spark):
    df = table(spark).where("day is not null").dropDuplicates(["g", "day"])
    checks = {"unique": Q.unique("day", "g"), "gaps": Q.no_gaps("day", ["g"], True)}
    got = {r.check: r.violations for r in Q.report(df, checks).collect()}
    assert got == {"unique": 0, "gaps": Q.no_gaps("day", ["g"], True)(df).count()}


def test_report_reads_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark).write.parquet(path)
    df = spark.read.parquet(path)
    checks = {k: c for k, c in every_check(spark).items() if k not in ("unique k", "own")}
    plan = Q.report(df, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_a_check_that_cannot_run_has_failed(spark):
    df = table(spark)
    checks = {"absent": Q.not_null("absent"), "fine": Q.not_empty(), "own": lambda x: x.select("nothing")}
    assert {r.check: r.violations for r in Q.report(df, checks).collect()} == {"absent": None, "fine": 0, "own": None}
    rolled = Q.roll_up({"t": Q.report(df, checks), "u": Q.report(df, {"n": Q.not_null("k")})}).collect()
    assert sorted(map(tuple, rolled)) == [("t", 3, 2, 0), ("u", 1, 1, 2)]
    with pytest.raises(AssertionError, match="absent: it could not run; own: it could not run"):
        Q.run_checks(df, checks)
    Q.run_checks(df, {"fine": Q.not_empty()})


def test_every_table_has_its_list():
    assert set(table_checks.LISTS) == set(table_checks.TABLES) and len(table_checks.LISTS) == 15
    for t, checks in table_checks.LISTS.items():
        assert f"Q15_checks_{t}" in registry.QUERIES and ("not_empty",) in checks and len({table_checks.name_of(x) for x in checks}) == len(checks)


@pytest.mark.parametrize("weekdays", [False, True])
def test_days_are_counted_by_the_ranges_that_made_them(spark, weekdays):
    d = lambda i: date(2024, 1, i)
    spans = [("a", d(1), d(9)), ("a", d(5), d(6)), ("a", d(6), d(12)), ("a", d(20), d(20)), ("b", d(3), d(3)), ("b", d(3), d(3)), ("c", d(9), d(2)), ("c", None, d(2)), ("d", d(9), None), (None, d(1), d(4)), (None, d(4), d(7)), ("e", d(6), d(7))]
    ranges = spark.createDataFrame([(*x, float(i) if i % 3 else None) for i, x in enumerate(spans)], "g string, a1 date, z1 date, v double")
    days = ranges.withColumn("day", F.explode(Q.days_between(F.col("a1"), F.col("z1"))))
    checks = {"not_empty": Q.not_empty(), "null": Q.not_null("v"), "since": Q.comparison("day", "<=", F.lit(d(6))), "unique": Q.unique("day", "g"), "gaps": Q.no_gaps("day", ["g"], weekdays), "fresh": Q.freshness("day", 3, F.lit(d(21)).cast("date")), "again": Q.unique("g")}
    for rows in (ranges, ranges.limit(0)):
        made = days.where("true") if rows is ranges else days.limit(0)
        found = Q.report(made, checks, Q.Ranges(rows, "a1", "z1", "day"))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, Q.report(made, checks).collect()))
    got = {r.check: r.violations for r in Q.report(days, checks, Q.Ranges(ranges, "a1", "z1", "day")).collect()}
    assert got["unique"] == 15 and got["gaps"] == (10 if weekdays else 14) and got["null"] == days.where("v is null").count() > 0
    alone = {r.check: r.violations for r in Q.report(days, {"u": Q.unique("g", "day")}, Q.Ranges(ranges, "a1", "z1", "day")).collect()}
    assert alone == {"u": 15}
