"""Checks: each counts the rows (or keys) that break a rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripmart.frames import empty_frame
from tripmart.operators.joins import orphans


@dataclass(frozen=True)
class RowCheck:
    """A rule on single rows; ``fails`` is true for a row that breaks it."""

    name: str
    column: str
    fails: Column


@dataclass(frozen=True)
class KeyCheck:
    """Each combination of the columns occurs once."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceCheck:
    """Each value of a column occurs in another table."""

    column: str
    parent: DataFrame
    parent_column: str


@dataclass(frozen=True)
class QueryCheck:
    """A query's only value equals the expected one."""

    name: str
    query: str
    expected: object


@dataclass(frozen=True)
class TableCheck:
    """A rule on the table as a whole; ``fails`` is an aggregate that is true if it is broken."""

    name: str
    column: str
    fails: Column


Check = RowCheck | KeyCheck | ReferenceCheck | QueryCheck | TableCheck


REPORT = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("failures", T.LongType()),
    ]
)


class CheckFailed(Exception):
    """A table broke at least one of its rules."""


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Sequence[object]) -> RowCheck:
    """NULL passes."""
    return RowCheck("accepted_values", column, ~F.col(column).isin(list(values)))


def positive(column: str) -> RowCheck:
    """More than zero; NULL passes."""
    return RowCheck("positive", column, F.col(column) <= 0)


def non_negative(column: str) -> RowCheck:
    """Zero or more; NULL passes."""
    return RowCheck("non_negative", column, F.col(column) < 0)


def unique(column: str) -> KeyCheck:
    """No value twice; NULLs are not counted."""
    return KeyCheck("unique", (column,))


def unique_combination(*columns: str) -> KeyCheck:
    """No combination twice; NULL counts as a value here."""
    return KeyCheck("unique_combination", columns)


def relationships(column: str, parent: DataFrame, parent_column: str) -> ReferenceCheck:
    """Values need a parent row; NULL passes."""
    return ReferenceCheck(column, parent, parent_column)


def custom_check(name: str, query: str, expected: object) -> QueryCheck:
    return QueryCheck(name, query, expected)


def has_rows() -> TableCheck:
    return TableCheck("row_count_positive", "", F.count("*") == 0)


def positive_total(column: str, name: str) -> TableCheck:
    return TableCheck(name, column, F.coalesce(F.sum(column), F.lit(0)) <= 0)


def _table_results(df: DataFrame, checks: Sequence[TableCheck]) -> DataFrame:
    counts = df.agg(*[c.fails.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    return _stacked(counts, checks)


def _row_results(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    # All row rules share one pass over the table.
    counts = df.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)])
    return _stacked(counts, checks)


def _stacked(counts: DataFrame, checks: Sequence[RowCheck | TableCheck]) -> DataFrame:
    results = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def _one(name: str, column: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), "failures"
    )


def _key_result(df: DataFrame, check: KeyCheck) -> DataFrame:
    rows = df.dropna(subset=list(check.columns)) if check.name == "unique" else df
    groups = rows.groupBy(*check.columns).agg(F.count("*").alias("_n"))
    counted = groups.filter("_n > 1").agg(F.count("*").alias("failures"))
    return _one(check.name, ", ".join(check.columns), counted)


def _reference_result(df: DataFrame, check: ReferenceCheck) -> DataFrame:
    lost = orphans(df, check.column, check.parent, check.parent_column)
    counted = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
    return _one("relationships", check.column, counted)


def _query_result(spark: SparkSession, check: QueryCheck) -> DataFrame:
    answer = spark.sql(check.query)
    field = answer.schema[0]
    value = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        value = value.cast("int")  # a truth value is expected as 1 or 0
    expected = int(check.expected) if isinstance(check.expected, bool) else check.expected
    wrong = F.count_if(~value.eqNullSafe(F.lit(expected)))
    counted = answer.agg(F.when(F.count("*") == 0, 1).otherwise(wrong).alias("failures"))
    return _one("custom", check.name, counted)


def check_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: what it is, how often it fails, whether it passed.

    Row checks share one pass over ``df``; every key, reference or custom check is a pass
    of its own, so write an expensive frame before checking it.
    """
    parts = [empty_frame(df.sparkSession, REPORT)]
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    if row_checks:
        parts.append(_row_results(df, row_checks))
    table_checks = [c for c in checks if isinstance(c, TableCheck)]
    if table_checks:
        parts.append(_table_results(df, table_checks))
    for check in checks:
        if isinstance(check, KeyCheck):
            parts.append(_key_result(df, check))
        elif isinstance(check, ReferenceCheck):
            parts.append(_reference_result(df, check))
        elif isinstance(check, QueryCheck):
            parts.append(_query_result(df.sparkSession, check))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def require_passed(report: DataFrame) -> DataFrame:
    """Raise if a check failed; a report has one row per check."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        lines = [f"{r['check_name']}({r['column_name']}): {r['failures']}" for r in failed]
        raise CheckFailed("; ".join(lines))
    return report


def freshness(
    df: DataFrame,
    time: str,
    now: dt.datetime | Column,
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """Age of the newest row and its state: pass, warn or error.

    An empty table has no age and is an error.
    """
    moment = now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(time).cast("timestamp_ntz")).alias("newest_at"))
    age = (F.unix_timestamp(moment) - F.unix_timestamp("newest_at")) / 3600.0
    hours = F.col("age_hours")
    state = (
        F.when(hours.isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", age).withColumn("state", state)
