"""Checks report the violations that are really there."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from saleslens.functions import day
from saleslens.operators import quality as Q


def records(df):
    return {(r.column, r.check_name): (r.status, r.n_violations, r.detail) for r in df.collect()}


def test_table_checks(spark):
    df = spark.createDataFrame(
        [(1, -1.0, dt.date(2019, 1, 1), None, 5.0, 4.0), (1, 2.0, dt.date(2020, 1, 1), "x", 1.0, 4.0), (2, 0.0, dt.date(2020, 1, 2), None, 4.0, 4.0)],
        "c int, v double, d date, n string, cogs double, price double")
    got = records(
        Q.TableChecks(df, "t").row_count(4).null_rate(["c"]).positive("v").date_range("d", day("2020-01-01"), day("2020-12-31"))
        .column_order("cogs", "price").constant("c", 1).constant("gone", 0).high_null("n", 0.5).high_null("missing").report())
    assert got[("", "row_count")][:2] == ("WARNING", 1)
    assert got[("n", "null_check")] == ("WARNING", 2, "nulls=2/3")
    assert got[("v", "positive_check")][:2] == ("ERROR", 2)
    assert got[("d", "date_range")][:2] == ("ERROR", 1)
    assert got[("cogs/price", "cogs_lt_price")][:2] == ("ERROR", 2)
    assert got[("c", "constant_check")][:2] == ("WARNING", 1)
    assert got[("gone", "constant_check")][0] == "PASS"
    assert got[("n", "high_null_check")][0] == "PASS"
    assert got[("missing", "high_null_check")][0] == "WARNING"


def test_foreign_key_examples(spark):
    child = spark.createDataFrame([(i,) for i in (9, 9, 8, 1, None, 7, 6, 5, 4)], "k bigint")
    parent = spark.createDataFrame([(1,), (None,)], "id bigint")
    r = Q.foreign_key(child, parent, "k", "id", "a->b").first()
    assert (r.status, r.n_violations, r.detail) == ("ERROR", 7, "examples=4,5,6,7,8")
    fine = Q.foreign_key(child.where("k = 1"), parent, "k", "id", "a->b").first()
    assert (fine.status, fine.n_violations) == ("PASS", 0)


def test_require_raises(spark):
    df = spark.range(3)
    Q.require(df, {"three": F.count(F.lit(1)) == 3})
    with pytest.raises(ValueError, match="four"):
        Q.require(df, {"four": F.count(F.lit(1)) == 4})


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_fused_checks_say_what_single_checks_say(spark):
    """Violations of every kind, NULL keys and days, and a parent that is a child elsewhere."""
    child = spark.createDataFrame(
        [(i, d, v, w) for i, d, v, w in zip(
            (9, 9, 8, 1, None, 7, 6, 5, 4), [dt.date(2019, 1, k) for k in range(1, 9)] + [None], (1.0, -1.0, 0.0, None, 2.0, 3.0, 4.0, 5.0, 6.0), (0.5,) * 9)],
        "k bigint, d date, v double, w double")
    parent = spark.createDataFrame([(1, 3), (2, 9), (None, 1)], "id bigint, other bigint")
    first, last = day("2019-01-03"), day("2019-01-04")
    audit = Q.FusedChecks(spark)
    audit.table(child, "a").row_count(7).row_count(-1).null_rate(["k", "v"]).positive("v").column_order("w", "v").date_range(
        "d", first, last).date_range("d", first, last, table="some", where=F.col("v") > 1).foreign_key("k", "a->b").key("k", "b->a").done()
    audit.table(parent, "b").row_count(3).key("id", "a->b").foreign_key("other", "b->a").done()
    some = child.where("v > 1")
    want = Q.combine([
        Q.TableChecks(child, "a").row_count(7).row_count(-1).report(), Q.TableChecks(child.select("k", "v"), "a").null_rate().report(),
        Q.TableChecks(child, "a").positive("v").column_order("w", "v").date_range("d", first, last).report(),
        Q.TableChecks(some, "some").date_range("d", first, last).report(), Q.foreign_key(child, parent, "k", "id", "a->b"),
        Q.TableChecks(parent, "b").row_count(3).report(), Q.foreign_key(parent, child, "other", "k", "b->a")])
    assert rows_of(audit.report()) == rows_of(want)


def test_fused_checks_of_empty_tables(spark):
    audit = Q.FusedChecks(spark)
    empty = spark.createDataFrame([], "k bigint, d date")
    audit.table(empty, "a").row_count(2).null_rate(["k"]).foreign_key("k", "a->b").done()
    audit.table(empty, "b").key("k", "a->b").done()
    want = Q.combine([Q.TableChecks(empty, "a").row_count(2).report(), Q.foreign_key(empty, empty, "k", "k", "a->b")])
    got = {(r.column, r.check_name): (r.status, r.n_violations, r.detail) for r in audit.report().collect()}
    for k, v in records(want).items():
        assert got[k] == v
    assert got[("k", "null_check")][:2] == ("PASS", 0)


def test_the_whole_report_scans_a_table_once(spark, monkeypatch):
    from saleslens.registry import checks as C
    from saleslens.sources import Tables

    folder, plans = "/root/testdata/sf0.001", []
    t = Tables(spark, folder)
    want = Q.combine([
        *C.row_counts(t), C.null_rates(t), *C.foreign_keys(t), *C.positives(t), *C.date_ranges(t), C.column_orders(t), C.constants(t), C.high_nulls(t)])
    real = Q.materialize

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(Q, "materialize", noted)
    monkeypatch.setattr("saleslens.sources.tables.materialize", noted)
    assert rows_of(C.fused_report(Tables(spark, folder))) == rows_of(want)
    scans = {c: sum(p.count(f"Relation [{c}") for p in plans) for c in ("l_orderkey", "o_orderkey", "p_partkey", "c_custkey", "event_id")}
    assert sum(p.count("Relation [") for p in plans) == sum(scans.values())  # no other table
    assert scans == {"l_orderkey": 2, "o_orderkey": 2, "p_partkey": 2, "c_custkey": 1, "event_id": 1}
