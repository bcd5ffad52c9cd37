from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from ordermill.schemas import RAW


def raw_rows(spark, table: str, *rows: dict):
    """Raw table from partial rows; absent columns are NULL."""
    schema = RAW[table]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text).quantize(Decimal("0.01"))


def rows(df, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
