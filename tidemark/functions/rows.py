"""Row identity and audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame) -> DataFrame:
    """F-18: add a random ``id`` and the insertion date and times."""
    now = F.date_trunc("second", F.current_timestamp())
    return df.withColumns(
        {
            "id": F.expr("uuid()"),
            "add_date": F.current_date(),
            "add_time": now,
            "update_time": now,
        }
    )
