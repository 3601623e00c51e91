"""Join helpers: size-checked broadcast and the zone lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bounds under which a dimension is broadcast; above them the join is
# left to Spark (sort-merge / shuffle-hash, with AQE skew splitting).
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after checking the side holds at most ``max_rows`` rows.

    The check is a bounded action (``limit(max_rows + 1).count()``) on the
    small side; a larger side is returned unhinted so the planner shuffles.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def zone_lookup_join(trips: DataFrame, zones: DataFrame, code_col: str = "zone_code",
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner equi-join of trips to the zone dimension on the zone code text.

    Unmatched codes drop out, exactly as a failed dictionary lookup did.
    ``zones`` is ``(zone_code, borough_name)``.
    """
    dim = broadcast_if_bounded(zones.select(F.col("zone_code").alias("_zone_code"),
                                            "borough_name"), max_broadcast_rows)
    return (trips.join(dim, trips[code_col] == dim["_zone_code"], "inner")
            .drop("_zone_code"))
