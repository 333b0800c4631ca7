"""Data checks that return one report row per check.

Every check yields (table, column, check_name, status, n_violations, detail).
All checks of a table come from one aggregate over one scan; its single row is
unfolded into report rows afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ratio
from ..sources.files import materialize
from .joins import orphan_counts

REPORT_COLUMNS = ["table", "column", "check_name", "status", "n_violations", "detail"]


def _record(table: str, column: str, check: str, status: Column, n: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(check).alias("check_name"),
        status.alias("status"), F.coalesce(n, F.lit(0)).cast("bigint").alias("n_violations"),
        detail.cast("string").alias("detail"),
    )


def _pass_or(bad: Column, otherwise: str) -> Column:
    return F.when(bad, F.lit(otherwise)).otherwise(F.lit("PASS"))


class TableChecks:
    """Collects checks on one table and runs them in a single aggregate."""

    def __init__(self, df: DataFrame, table: str):
        self.df = df
        self.table = table
        self._aggs: dict[str, Column] = {}
        self._records: list[Column] = []

    def _agg(self, expr: Column) -> Column:
        name = f"_a{len(self._aggs)}"
        self._aggs[name] = expr
        return F.col(name)

    def row_count(self, expected: int) -> TableChecks:
        """WARNING with the absolute gap; a negative expectation is not checked."""
        if expected >= 0:
            n = self._agg(F.count(F.lit(1)))
            gap = F.abs(n - F.lit(expected))
            self._records.append(_record(
                self.table, "", "row_count", _pass_or(gap > 0, "WARNING"), gap,
                F.concat(F.lit("rows="), n.cast("string"), F.lit(f" expected={expected}"))))
        return self

    def null_rate(self, nullable: list[str] | None = None) -> TableChecks:
        """One record per column that may not be NULL."""
        total = self._agg(F.count(F.lit(1)))
        for c in [c for c in self.df.columns if c not in (nullable or [])]:
            n = self._agg(F.count_if(F.col(c).isNull()))
            self._records.append(_record(
                self.table, c, "null_check", _pass_or(n > 0, "WARNING"), n,
                F.concat(F.lit("nulls="), n.cast("string"), F.lit("/"), total.cast("string"))))
        return self

    def positive(self, column: str) -> TableChecks:
        n = self._agg(F.count_if(F.col(column) <= 0))
        self._records.append(_record(
            self.table, column, "positive_check", _pass_or(n > 0, "ERROR"), n,
            F.concat(F.lit("not_positive="), n.cast("string"))))
        return self

    def date_range(self, column: str, first: Column, last: Column, examples: int = 3) -> TableChecks:
        outside = ~F.col(column).between(first, last)
        n = self._agg(F.count_if(outside))
        lo, hi = self._agg(F.min(column)), self._agg(F.max(column))
        # A set of distinct days, so it stays small.
        days = self._agg(F.collect_set(F.when(outside, F.col(column))))
        shown = F.array_join(F.transform(F.slice(F.sort_array(days), 1, examples), lambda d: d.cast("string")), ",")
        self._records.append(_record(
            self.table, column, "date_range", _pass_or(n > 0, "ERROR"), n,
            F.concat(F.lit("min="), lo.cast("string"), F.lit(" max="), hi.cast("string"), F.lit(" examples="), shown)))
        return self

    def column_order(self, smaller: str, larger: str) -> TableChecks:
        n = self._agg(F.count_if(F.col(smaller) >= F.col(larger)))
        self._records.append(_record(
            self.table, f"{smaller}/{larger}", f"{smaller}_lt_{larger}", _pass_or(n > 0, "ERROR"), n,
            F.concat(F.lit("violations="), n.cast("string"))))
        return self

    def constant(self, column: str, value) -> TableChecks:
        """WARNING unless every row has the given value; counts the surplus values."""
        if column not in self.df.columns:
            self._records.append(_record(
                self.table, column, "constant_check", F.lit("PASS"), F.lit(0), F.lit("column dropped")))
            return self
        kinds = self._agg(F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("int")))
        other = self._agg(F.count_if(~F.col(column).eqNullSafe(F.lit(value))))
        self._records.append(_record(
            self.table, column, "constant_check", _pass_or(other > 0, "WARNING"),
            F.when(other > 0, F.greatest(kinds - 1, F.lit(0))).otherwise(F.lit(0)),
            F.concat(F.lit("values="), kinds.cast("string"))))
        return self

    def high_null(self, column: str, at_least: float = 0.95) -> TableChecks:
        """WARNING when fewer values than expected are NULL."""
        if column not in self.df.columns:
            self._records.append(_record(
                self.table, column, "high_null_check", F.lit("WARNING"), F.lit(0), F.lit("column missing")))
            return self
        nulls = self._agg(F.count_if(F.col(column).isNull()))
        total = self._agg(F.count(F.lit(1)))
        self._records.append(_record(
            self.table, column, "high_null_check", _pass_or(ratio(nulls, total) < at_least, "WARNING"), F.lit(0),
            F.concat(F.lit("nulls="), nulls.cast("string"), F.lit("/"), total.cast("string"))))
        return self

    def report(self) -> DataFrame:
        row = self.df.agg(*[e.alias(n) for n, e in self._aggs.items()])
        return row.select(F.explode(F.array(*self._records)).alias("r")).select("r.*")


def foreign_key(child: DataFrame, parent: DataFrame, fk: str, pk: str, table: str, examples: int = 5) -> DataFrame:
    """ERROR with the number of child rows whose key has no parent, and the smallest such keys."""
    orphans = orphan_counts(child, parent, fk, pk)
    shown = orphans.orderBy("key").limit(examples).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("key")), lambda k: k.cast("string"))).alias("e"))
    n = F.coalesce(F.sum("n"), F.lit(0))
    return orphans.agg(n.alias("_n")).withColumn("_e", shown.scalar()).select(_record(
        table, fk, f"fk_integrity_{fk}", _pass_or(F.col("_n") > 0, "ERROR"), F.col("_n"),
        F.concat(F.lit("examples="), F.coalesce("_e", F.lit("")))).alias("r")).select("r.*")


class FusedChecks:
    """Checks of many tables as one count of tagged keys, with one scan per table.

    Every row of a table gives a few (tag, key) pairs: a flag, a day, a value, a
    foreign or a primary key.  Pairs are counted together, map-side first, so that
    flags and days are a handful of rows per task; only keys travel as such, and a
    child's and its parent's keys meet in the same count.  What the report needs of
    it (flags, values, days, keys without a parent) is written and read once more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tags: list[str] = []
        self._keys: set[int] = set()
        self._sources: list[DataFrame] = []
        self._checks: list[Callable[[DataFrame], Column]] = []
        self._aggs: dict[str, Column] = {}

    def table(self, df: DataFrame, name: str) -> FusedTable:
        return FusedTable(self, df, name)

    def _tag(self, name: str, key: bool = False) -> int:
        if name not in self._tags:
            self._tags.append(name)
        if key:
            self._keys.add(self._tags.index(name))
        return self._tags.index(name)

    def _sum(self, tag: int, where: Column | None = None) -> Column:
        """Rows with a tag, and a key that meets a condition."""
        hit = F.col("tag") == tag
        return self._agg(F.coalesce(F.sum(F.when(hit if where is None else hit & where, F.col("n")).otherwise(0)), F.lit(0)))

    def _agg(self, expr: Column) -> Column:
        name = f"_a{len(self._aggs)}"
        self._aggs[name] = expr
        return F.col(name)

    def report(self) -> DataFrame:
        pairs = reduce(DataFrame.unionByName, self._sources)
        counts = pairs.groupBy("tag", "key").agg(F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("parent"))
        is_key = F.col("tag").isin(sorted(self._keys))
        orphan = ~F.col("parent") & F.col("key").isNotNull()
        facts = materialize(counts.where(~is_key | orphan), "check-facts")
        records = [check(facts) for check in self._checks]
        row = facts.agg(*[e.alias(n) for n, e in self._aggs.items()])
        return row.select(F.explode(F.array(*records)).alias("r")).select("r.*")


class FusedTable:
    """Checks on one table; ``done`` hands its pairs over."""

    def __init__(self, owner: FusedChecks, df: DataFrame, name: str):
        self.owner, self.df, self.name = owner, df, name
        self._pairs: list[Column] = []

    def _pair(self, tag: str, key: Column, parent: bool = False, is_key: bool = False) -> int:
        at = self.owner._tag(tag, is_key)
        self._pairs.append(F.struct(F.lit(at).alias("tag"), key.cast("bigint").alias("key"), F.lit(parent).alias("parent")))
        return at

    def _check(self, column: str, check: str, build: Callable[[DataFrame], tuple[Column, Column, Column]], table: str | None = None):
        def record(facts: DataFrame) -> Column:
            status, n, detail = build(facts)
            return _record(table or self.name, column, check, status, n, detail)

        self.owner._checks.append(record)

    def _rows(self) -> int:
        tag = f"{self.name} rows"
        return self._pair(tag, F.lit(0)) if tag not in self.owner._tags else self.owner._tag(tag)

    def row_count(self, expected: int) -> FusedTable:
        """As ``TableChecks.row_count``."""
        if expected >= 0:
            tag = self._rows()

            def build(_):
                n = self.owner._sum(tag)
                gap = F.abs(n - F.lit(expected))
                return _pass_or(gap > 0, "WARNING"), gap, F.concat(F.lit("rows="), n.cast("string"), F.lit(f" expected={expected}"))

            self._check("", "row_count", build)
        return self

    def null_rate(self, columns: list[str]) -> FusedTable:
        for c in columns:
            tag = self._pair(f"{self.name} {c} null", F.col(c).isNull().cast("int"))

            def build(_, tag=tag):
                n, total = self.owner._sum(tag, F.col("key") == 1), self.owner._sum(tag)
                return _pass_or(n > 0, "WARNING"), n, F.concat(F.lit("nulls="), n.cast("string"), F.lit("/"), total.cast("string"))

            self._check(c, "null_check", build)
        return self

    def _violations(self, column: str, check: str, bad: Column, label: str) -> FusedTable:
        tag = self._pair(f"{self.name} {column} {check}", F.coalesce(bad, F.lit(False)).cast("int"))

        def build(_):
            n = self.owner._sum(tag, F.col("key") == 1)
            return _pass_or(n > 0, "ERROR"), n, F.concat(F.lit(f"{label}="), n.cast("string"))

        self._check(column, check, build)
        return self

    def positive(self, column: str) -> FusedTable:
        return self._violations(column, "positive_check", F.col(column) <= 0, "not_positive")

    def column_order(self, smaller: str, larger: str) -> FusedTable:
        return self._violations(f"{smaller}/{larger}", f"{smaller}_lt_{larger}", F.col(smaller) >= F.col(larger), "violations")

    def date_range(self, column: str, first: Column, last: Column, examples: int = 3, table: str | None = None, where: Column | None = None) -> FusedTable:
        """As ``TableChecks.date_range``; ``where`` limits it to some rows of the table."""
        epoch = F.lit("1970-01-01").cast("date")
        own = F.col(column) if where is None else F.when(where, F.col(column))
        tag = self._pair(f"{table or self.name} {column} day", F.datediff(own, epoch))

        def build(_):
            day = F.when(F.col("tag") == tag, F.date_add(epoch, F.col("key").cast("int")))
            outside = ~day.between(first, last)
            n = self.owner._sum(tag, outside)
            lo, hi, days = (self.owner._agg(e) for e in (F.min(day), F.max(day), F.collect_set(F.when(outside, day))))
            shown = F.array_join(F.transform(F.slice(F.sort_array(days), 1, examples), lambda d: d.cast("string")), ",")
            return _pass_or(n > 0, "ERROR"), n, F.concat(
                F.lit("min="), lo.cast("string"), F.lit(" max="), hi.cast("string"), F.lit(" examples="), shown)

        self._check(column, "date_range", build, table)
        return self

    def key(self, column: str, relation: str) -> FusedTable:
        """The table is the parent of a relation by this column."""
        self._pair(relation, F.col(column), parent=True, is_key=True)
        return self

    def foreign_key(self, column: str, relation: str, examples: int = 5, where: Column | None = None) -> FusedTable:
        """As ``foreign_key``: the table is the child of a relation by this column."""
        own = F.col(column) if where is None else F.when(where, F.col(column))
        tag = self._pair(relation, own, is_key=True)

        def build(facts):
            n = self.owner._sum(tag)
            keys = facts.where(F.col("tag") == tag).orderBy("key").limit(examples).agg(
                F.array_join(F.transform(F.sort_array(F.collect_list("key")), lambda k: k.cast("string")), ",").alias("e"))
            return _pass_or(n > 0, "ERROR"), n, F.concat(F.lit("examples="), keys.scalar())

        self._check(column, f"fk_integrity_{column}", build, relation)
        return self

    def done(self) -> FusedChecks:
        one = self.df.select(F.explode(F.array(*self._pairs)).alias("p")).select("p.*")
        self.owner._sources.append(one)
        return self.owner


def high_null_counts(counts: DataFrame, table: str, total: str, known: list[str], at_least: float = 0.95) -> DataFrame:
    """As ``TableChecks.high_null`` from one row with the number of rows and of known values of each column."""
    records = []
    for c in known:
        nulls = F.col(total) - F.col(c)
        records.append(_record(
            table, c, "high_null_check", _pass_or(ratio(nulls, total) < at_least, "WARNING"), F.lit(0),
            F.concat(F.lit("nulls="), nulls.cast("string"), F.lit("/"), F.col(total).cast("string"))))
    return counts.select(F.explode(F.array(*records)).alias("r")).select("r.*")


def combine(reports: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


def totals(report: DataFrame) -> DataFrame:
    """Number of checks and of violations per status."""
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_checks"), F.sum("n_violations").alias("n_violations"))


def require(df: DataFrame, checks: dict[str, Column]) -> dict:
    """Evaluate boolean aggregates over the table; raise on any that is not true."""
    got = df.agg(*[c.alias(n) for n, c in checks.items()]).first().asDict()
    failed = [n for n, ok in got.items() if not ok]
    if failed:
        raise ValueError(f"failed checks: {failed}")
    return got


def base_table_summary(df: DataFrame, date: str, target: str, test_start: Column) -> DataFrame:
    """The facts the base table is checked on, as one row."""
    first, last = F.min(date), F.max(date)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.datediff(last, first) + 1).cast("bigint").alias("n_days"),
        F.countDistinct(date).alias("n_distinct_days"),
        first.alias("first_date"), last.alias("last_date"),
        F.count_if((F.col(date) >= test_start) & F.col(target).isNotNull()).alias("n_test_targets"),
    ).withColumn("ok", (F.col("n_rows") == F.col("n_days")) & (F.col("n_rows") == F.col("n_distinct_days"))
                 & (F.col("n_test_targets") == 0))


def forecast_summary(df: DataFrame, expected_rows: DataFrame, values: list[str]) -> DataFrame:
    """Row count against the template, NULLs and negative values, as one row."""
    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        sum((F.count_if(F.col(v).isNull()) for v in values[1:]), F.count_if(F.col(values[0]).isNull())).alias("n_null"),
        sum((F.count_if(F.col(v) < 0) for v in values[1:]), F.count_if(F.col(values[0]) < 0)).alias("n_negative"),
    ).withColumn("n_expected", expected_rows.agg(F.count(F.lit(1)).alias("n")).scalar())
    return row.withColumn("ok", (F.col("n_rows") == F.col("n_expected")) & (F.col("n_null") == 0) & (F.col("n_negative") == 0))
