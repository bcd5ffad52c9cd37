"""Exchange rates from an API response, and amounts converted with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shape of the response, its base currency and the two currencies picked.
RESPONSE = "rates MAP<STRING, DOUBLE>, time_last_update_unix BIGINT"
BASE = "USD"
PICKED = {"brl_to_usd": "BRL", "vnd_to_usd": "VND"}


def parse_rates(responses: DataFrame, body: str = "body", fetched_at: str | None = None) -> DataFrame:
    """Rates quoted per US dollar, inverted to dollars per unit.

    The time is the response's own; a response without one takes the column ``fetched_at``, if
    given, or else the time of the query.
    """
    response = F.from_json(F.col(body), RESPONSE)
    rates = response["rates"]
    fetched = F.col(fetched_at) if fetched_at else F.current_timestamp()
    return responses.select(
        F.coalesce(F.timestamp_seconds(response["time_last_update_unix"]), fetched).alias("fetched_at"),
        F.lit(BASE).alias("base_currency"),
        *(F.try_divide(F.lit(1.0), F.element_at(rates, code)).alias(name) for name, code in PICKED.items()),
    )


def latest_rate(rates: DataFrame, name: str = "brl_to_usd") -> float:
    """Newest rate as a single number; of several at one time, the largest."""
    known = rates.where(F.col(name).isNotNull())
    return known.agg(F.max_by(name, F.struct("fetched_at", name))).first()[0]


def convert(amounts: DataFrame, column: str, rate: float, target: str) -> DataFrame:
    return amounts.withColumn(target, F.col(column).cast("double") * F.lit(rate))
