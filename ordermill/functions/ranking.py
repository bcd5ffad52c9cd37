"""Exact equal-share bands of several columns without a global sort."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A part of the value range aims at this many distinct values.
VALUES_PER_PART = 200_000


def _nested(lists: list[list], suffix: str, element: str) -> Column:
    """Array of arrays as a literal, written as one expression."""
    inner = (f"cast(array({', '.join(f'{x}{suffix}' for x in values)}) AS array<{element}>)" for values in lists)
    return F.expr(f"array({', '.join(inner)})")


def _common_number(df: DataFrame, measures: dict[str, Column]) -> str:
    """Decimal type that holds every measure without rounding."""
    kinds = [f.dataType for f in df.select(*(m.alias(n) for n, m in measures.items())).schema.fields]
    if not all(isinstance(k, (T.DecimalType, T.IntegralType)) for k in kinds):
        raise TypeError("bands need exact numbers: integers or decimals")
    return f"decimal(38,{max(k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds)})"


def band_edges(
    df: DataFrame, measures: dict[str, Column], bands: int, values_per_part: int = VALUES_PER_PART
) -> dict[str, list[Decimal]]:
    """Per measure, the largest value of each share but the last of ``bands`` equal ones.

    Rows collapse into one row per distinct value with its count, so a value shared by a
    third of the rows costs one row. Approximate quantiles of the distinct values cut them
    into parts of about equal size. A running count inside each part, plus the totals of the
    parts before it, is the exact running count over all values; the approximation only
    affects how evenly the work is spread. The driver gets one number per part and
    ``bands - 1`` edges per measure.
    """
    names = list(measures)
    number = _common_number(df, measures)
    entries = F.array(
        *(
            F.struct(F.lit(i).alias("measure"), measures[name].cast(number).alias("value"))
            for i, name in enumerate(names)
        )
    )
    counted = (
        df.select(F.explode(entries).alias("e"))
        .selectExpr("e.measure", "e.value", "cast(e.value AS DOUBLE) AS position")
        .where("value IS NOT NULL")
        .groupBy("measure", "value", "position")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    cuts: list[list[float]] = [[] for _ in names]
    # As many parts as the values need, so that a part stays of the same size however many there are.
    for row in counted.groupBy("measure").count().collect():
        parts = -(-row["count"] // values_per_part)
        if parts > 1:
            steps = F.expr(f"array({', '.join(f'{k / parts}D' for k in range(1, parts))})")
            own = counted.where(F.col("measure") == row["measure"])
            found = own.agg(F.percentile_approx("position", steps, F.lit(max(10_000, 20 * parts)))).first()[0]
            cuts[row["measure"]] = sorted(set(found))

    parted = counted.withColumn("cuts", _nested(cuts, "D", "double")[F.col("measure")]).selectExpr(
        "measure", "value", "n", "size(filter(cuts, cut -> cut < position)) AS part"
    )
    totals = [[0] * (len(c) + 1) for c in cuts]
    for row in parted.groupBy("measure", "part").agg(F.sum("n").alias("n")).collect():
        totals[row["measure"]][row["part"]] = row["n"]
    before = [[sum(t[:i]) for i in range(len(t))] for t in totals]

    running = F.sum("n").over(Window.partitionBy("measure", "part").orderBy("value"))
    upto = running + _nested(before, "L", "bigint")[F.col("measure")][F.col("part")]
    reached = parted.select("measure", "value", upto.alias("upto"))

    def edge(i: int, k: int) -> Column:
        wanted = -(-k * sum(totals[i]) // bands)
        return F.min(F.when((F.col("measure") == i) & (F.col("upto") >= wanted), F.col("value")))

    found = reached.agg(
        *(edge(i, k).alias(f"e{i}_{k}") for i in range(len(names)) for k in range(1, bands))
    ).first()
    return {name: [found[f"e{i}_{k}"] for k in range(1, bands)] for i, name in enumerate(names)}


def band(column: Column, edges: list[Decimal]) -> Column:
    """1 plus the number of edges below the value; NULL stays NULL."""
    score = F.lit(1)
    for edge in edges:
        score = score + F.when(column > F.lit(edge), 1).otherwise(0)
    return F.when(column.isNotNull(), score)
