"""Size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast a table only when it has at most this many rows. Real dimensions
# (days, products, ~6k cities, ~50k station versions, file lists) are far
# below; beyond it the join falls back to a shuffle join.
BROADCAST_ROW_LIMIT = 2_000_000


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if its row count is within ``limit``.

    Callers pass small stored or checkpointed tables, so the count is cheap.
    """
    return F.broadcast(df) if df.count() <= limit else df
