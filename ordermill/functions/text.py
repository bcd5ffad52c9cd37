"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_digest(seed: str, key: Column) -> Column:
    """Hex digest of seed and key: repeatable, and evenly spread over its values."""
    return F.sha2(F.concat(F.lit(seed), key), 256)
