"""Declarative data tests: expectations, one-pass checking, gate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["model", "column", "test", "severity", "failing_rows"]


@dataclass(frozen=True)
class Expectation:
    """``failing_rows`` counts rows for row tests, repeated values for ``unique``."""

    column: str
    test: str  # not_null | unique | accepted_values | expression_is_true
    values: tuple = ()
    expression: str = ""
    severity: str = "error"

    def violated(self) -> Column:
        column = F.col(self.column)
        if self.test == "not_null":
            return column.isNull()
        if self.test == "accepted_values":
            return column.isNotNull() & ~column.isin(*self.values)
        if self.test == "expression_is_true":
            return ~F.expr(self.expression)  # unknown passes, as in a CHECK constraint
        raise ValueError(self.test)


def not_null(*columns: str, severity: str = "error") -> list[Expectation]:
    return [Expectation(c, "not_null", severity=severity) for c in columns]


def unique(column: str, severity: str = "error") -> list[Expectation]:
    return [Expectation(column, "unique", severity=severity)]


def accepted_values(column: str, values: list, severity: str = "error") -> list[Expectation]:
    return [Expectation(column, "accepted_values", values=tuple(values), severity=severity)]


def check(column: str, expression: str, severity: str = "error") -> list[Expectation]:
    return [Expectation(column, "expression_is_true", expression=expression, severity=severity)]


def repeated_values(rows: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their number of rows."""
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def _label(model: str, e: Expectation) -> list[Column]:
    texts = {"model": model, "column": e.column, "test": e.test, "severity": e.severity}
    return [F.lit(v).alias(k) for k, v in texts.items()]


def run_expectations(model: str, rows: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One result row per expectation. All row tests share a single scan and aggregate."""
    row_tests = [e for e in expectations if e.test != "unique"]
    parts = []
    if row_tests:
        counts = rows.agg(
            *[F.count_if(e.violated()).alias(f"_{i}") for i, e in enumerate(row_tests)]
        )
        results = F.array(
            *[
                F.struct(*_label(model, e), F.col(f"_{i}").alias("failing_rows"))
                for i, e in enumerate(row_tests)
            ]
        )
        parts.append(counts.select(F.explode(results).alias("_r")).select("_r.*"))
    for e in expectations:
        if e.test == "unique":
            repeated = repeated_values(rows, e.column)
            parts.append(repeated.agg(F.count(F.lit(1)).alias("failing_rows")).select(
                *_label(model, e), "failing_rows"
            ))
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLUMNS)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("_parent"), "left_anti"
    )


def referential(
    model: str,
    child: DataFrame,
    child_key: str,
    parent: DataFrame,
    parent_key: str,
    severity: str = "error",
) -> DataFrame:
    """Result row of a referential test.

    Child keys are counted before the join, so a parent referenced by very many rows costs one.
    """
    keys = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("_n"))
    missing = orphans(keys, child_key, parent, parent_key)
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failing_rows")).select(
        F.lit(model).alias("model"),
        F.lit(child_key).alias("column"),
        F.lit("relationships").alias("test"),
        F.lit(severity).alias("severity"),
        "failing_rows",
    )


class QualityError(RuntimeError):
    """At least one test of severity ``error`` failed."""


def gate(results: DataFrame) -> DataFrame:
    """Raise if a test of severity ``error`` failed; the results have one row per test."""
    failed = results.filter("severity = 'error' AND failing_rows > 0").collect()
    if failed:
        lines = [f"{r['model']}.{r['column']} {r['test']}: {r['failing_rows']}" for r in failed]
        raise QualityError("; ".join(sorted(lines)))
    return results
