"""Bad lines of CSV files and bucketed tables."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslens.sources import Tables, bad_lines_by_file, read_csv_with_quarantine, register_bucketed
from saleslens.sources.schemas import STORED

SCHEMA = StructType().add("order_id", "long").add("order_date", "date").add("amount", "double")
GOOD = ["1,2020-01-01,5.5", "2,2020-02-29,", "3,,1e3"]


def folder_of(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


@pytest.mark.parametrize("bad", ["x,2020-01-01,5", "4,2020-02-30,5", "4,01/02/2020,5", "4,2020-01-01,5 EUR", "4,2020-01-01", "4,2020-01-01,5,6", "one"])
def test_a_bad_line_goes_to_the_quarantine(spark, tmp_path, bad):
    path = folder_of(tmp_path, a=["order_id,order_date,amount", *GOOD], b=["order_id,order_date,amount", *GOOD[:1], bad])
    rows, quarantine = read_csv_with_quarantine(spark, path, SCHEMA, max_bad_share=0.5)
    assert rows.count() == 4 and rows.schema.names == SCHEMA.names and rows.select(F.sum("amount")).first()[0] == 1011.0
    (left,) = quarantine.collect()
    assert left.line == bad and left.file.endswith("b.csv")
    # Fewer columns asked for find the same bad lines.
    assert rows.select("order_id").count() == 4
    assert [(r.file[-5:], r.n_lines) for r in bad_lines_by_file(quarantine).collect()] == [("b.csv", 1)]


def test_too_many_bad_lines_end_the_job(spark, tmp_path):
    path = folder_of(tmp_path, a=["order_id,order_date,amount", *GOOD], b=["order_id,amount", "1,5", "2,6"])  # a file without a column
    with pytest.raises(ValueError, match=r"2 of 5 lines are bad.*b\.csv"):
        read_csv_with_quarantine(spark, path, SCHEMA)
    rows, quarantine = read_csv_with_quarantine(spark, path, SCHEMA, max_bad_share=0.4)
    assert rows.count() == 3 and sorted(r.line for r in quarantine.collect()) == ["1,5", "2,6"]


def test_no_lines(spark, tmp_path):
    rows, quarantine = read_csv_with_quarantine(spark, folder_of(tmp_path, a=["order_id,order_date,amount"]), SCHEMA, 0.0)
    assert rows.count() == 0 and quarantine.count() == 0


def test_bucketed_lines_join_orders_without_a_shuffle(spark, tmp_path):
    plain = Tables(spark, "/root/testdata/sf0.001")
    name = f"t{uuid.uuid4().hex}"
    own = plain.bucketed(str(tmp_path), name, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [t.lines._jdf.queryExecution().executedPlan().toString() for t in (plain, own)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" in plans[0] and "Exchange" not in plans[1] and "SortMergeJoin" in plans[1]
    assert sorted(map(tuple, own.lines.collect())) == sorted(map(tuple, plain.lines.collect()))
    files = [p.name for p in (tmp_path / "lineitem").glob("*.parquet")]
    assert len(files) == 4  # one per bucket
    again = register_bucketed(spark, str(tmp_path / "orders"), f"{name}_again", STORED["orders"], "o_orderkey", 4)
    assert spark.table(again).count() == plain.raw("orders").count()
