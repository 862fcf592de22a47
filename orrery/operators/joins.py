"""Join helper: the broadcast hint for sides that are bounded by construction.

All other sides are left to the planner's size threshold and to AQE's sizes at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a side whose size is bounded by construction
    (fixed code lists, a calendar over a date range, a 25-row nation table)."""
    return F.broadcast(df)
