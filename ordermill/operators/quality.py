"""Declarative data checks.

A check gives the failing rows, so an empty result passes. ``report`` counts failures for
a whole layer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULLs do not count."""
    return (
        df.groupBy(column)
        .agg(F.count(column).alias("copies"))
        .where("copies > 1")
    )


def _outside(column: str, values: tuple) -> Column:
    return ~F.col(column).isin(*values)


def accepted_values(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Rows with a value not listed; NULL passes."""
    return df.where(_outside(column, values))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row and how many rows carry them; NULL passes.

    Child rows are counted per value before the join, so a frequent value travels once.
    """
    carried = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return carried.join(known, column, "left_anti")


def _below(column: str, low: Any, inclusive: bool) -> Column:
    value = F.col(column)
    return ~(value >= low) if inclusive else ~(value > low)


def accepted_range(df: DataFrame, column: str, low: Any, inclusive: bool = True) -> DataFrame:
    """Rows below the bound, or equal to it unless ``inclusive``; NULL passes."""
    return df.where(_below(column, low, inclusive))


@dataclass(frozen=True)
class Check:
    """One declared check on a column of a model."""

    model: str
    column: str
    kind: str
    values: tuple = ()
    low: Any = None
    inclusive: bool = True
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        if self.kind == "accepted_range":
            return f"{self.kind}_{'from' if self.inclusive else 'above'}_{self.low}"
        return f"{self.kind}_{self.parent}" if self.parent else self.kind


def _failing(check: Check) -> Column | None:
    """Row predicate of the checks that need no other row."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return _outside(check.column, check.values)
    if check.kind == "accepted_range":
        return _below(check.column, check.low, check.inclusive)
    return None


def _across_rows(check: Check, column: DataFrame, models: dict[str, DataFrame]) -> DataFrame:
    """One count from (value, rows) of the tested column."""
    if check.kind == "unique":
        return column.agg(F.count_if(F.col(check.column).isNotNull() & (F.col("rows") > 1)).alias("failures"))
    known = models[check.parent].select(F.col(check.parent_column).alias(check.column))
    orphans = column.where(F.col(check.column).isNotNull()).join(known, check.column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))


def _model_report(model: str, df: DataFrame, own: list[Check], models: dict[str, DataFrame]) -> list[DataFrame]:
    """All checks of one model.

    Row-level checks are counted in one pass that shuffles nothing but a row per task. A column that is tested across rows
    collapses to its values and their rows, map-side first, and serves all its checks; only that column is read for it.
    """
    simple = [c for c in own if _failing(c) is not None]
    parts = []
    if simple:
        sums = df.agg(*(F.count_if(_failing(c)).alias(f"c{i}") for i, c in enumerate(simple)))
        entries = ", ".join(f"'{c.column}', '{c.name}', c{i}" for i, c in enumerate(simple))
        parts.append(sums.selectExpr(
            f"'{model}' AS model", f"stack({len(simple)}, {entries}) AS (column_name, check_name, failures)"
        ))
    for check in own:
        if _failing(check) is None:
            column = df.groupBy(check.column).agg(F.count(F.lit(1)).alias("rows"))
            failed = _across_rows(check, column, models)
            parts.append(failed.selectExpr(
                f"'{model}' AS model", f"'{check.column}' AS column_name", f"'{check.name}' AS check_name", "failures"
            ))
    return parts


def report(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Failures of every check on the given models: one row per check."""
    parts = []
    for model, df in models.items():
        own = [c for c in checks if c.model == model]
        if own:
            parts.extend(_model_report(model, df, own, models))
    return reduce(DataFrame.unionByName, parts)


class QualityError(Exception):
    """A layer has failing checks."""


def gate(checked: DataFrame) -> list:
    """Raise if any check failed; the report has one row per declared check."""
    rows = checked.collect()
    failed = [r for r in rows if r["failures"]]
    if failed:
        raise QualityError(
            "; ".join(f"{r['model']}.{r['column_name']} {r['check_name']}: {r['failures']}" for r in failed)
        )
    return rows
