"""Parse raw trip lines into validated, time-bucketed trips.

The same transforms serve files (``spark.read.text``) and stream messages
(``value`` column), batch and streaming alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.functions.text import field, float_value, is_int_text, tokens
from tripdemand.functions.time import day_name, month_name, parse_pickup, time_block
from tripdemand.operators.joins import zone_lookup_join
from tripdemand.schemas import BLOCK_MINUTES, MIN_FIELDS, ZONE_FIELD


def with_time_features(df: DataFrame, ts_col: str = "pickup_ts",
                       block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """``time_block``, ``month`` and ``day`` names from a timestamp column."""
    ts = F.col(ts_col)
    return (df.withColumn("time_block", time_block(ts, block_minutes))
            .withColumn("month", month_name(ts))
            .withColumn("day", day_name(ts)))


def _pickup(on_bad_timestamp: str) -> Column:
    ts = parse_pickup(F.col("_pickup_text"))
    if on_bad_timestamp == "drop":
        return ts
    if on_bad_timestamp == "fail":
        # Fail the job on the first otherwise-valid row with a bad timestamp.
        return F.coalesce(ts, F.raise_error(F.concat(
            F.lit("malformed pickup timestamp: "),
            F.coalesce(F.col("_pickup_text"), F.lit("NULL")))).cast("timestamp_ntz"))
    raise ValueError(f"on_bad_timestamp must be 'drop' or 'fail', not {on_bad_timestamp!r}")


def keep_where(df: DataFrame, valid: str, columns: list[str]) -> DataFrame:
    """Rows whose boolean column ``valid`` is true, projected to ``columns``.

    Written as a generator (``inline`` of a zero- or one-element array)
    rather than a filter: a filter would be pushed below the projection
    that computes its inputs, re-evaluating the tokenizer and the
    timestamp parse once per predicate. Here each is computed once.
    """
    row = F.struct(*[F.col(c) for c in columns])
    return df.select(F.inline(F.when(F.col(valid), F.array(row))))


def _token_fields(lines: DataFrame, value_col: str, picks: dict[str, int]) -> DataFrame:
    """Split each line once; pick fields by index (NULL past the end)."""
    toks = lines.select(tokens(F.col(value_col)).alias("_f"))
    return toks.select(F.size("_f").alias("_n"), field(F.col("_f"), 1).alias("_pickup_text"),
                       *[field(F.col("_f"), i).alias(n) for n, i in picks.items()])


def zone_trip_fields(lines: DataFrame, value_col: str = "value",
                     zone_field: int = ZONE_FIELD,
                     on_bad_timestamp: str = "drop") -> DataFrame:
    """``(pickup_ts, zone_code)`` for lines that pass validation.

    Lines with fewer than 7 fields or a non-integer zone field vanish; rows
    with a malformed pickup are dropped (``'drop'``) or fail the job
    (``'fail'``, the original behaviour).
    """
    raw = _token_fields(lines, value_col, {"zone_code": zone_field})
    shaped = (F.col("_n") >= MIN_FIELDS) & is_int_text(F.col("zone_code"))
    checked = raw.select("zone_code", shaped.alias("_shaped"),
                         F.when(shaped, _pickup(on_bad_timestamp)).alias("pickup_ts"))
    checked = checked.withColumn("_ok", F.col("_shaped") & F.col("pickup_ts").isNotNull())
    return keep_where(checked, "_ok", ["pickup_ts", "zone_code"])


def parse_zone_trips(lines: DataFrame, zones: DataFrame, value_col: str = "value",
                     zone_field: int = ZONE_FIELD, on_bad_timestamp: str = "drop",
                     block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """Zone-coded lines -> ``(pickup_ts, time_block, month, day, borough_name)``."""
    fields = zone_trip_fields(lines, value_col, zone_field, on_bad_timestamp)
    joined = zone_lookup_join(fields, zones)
    return with_time_features(joined, "pickup_ts", block_minutes).select(
        "pickup_ts", "time_block", "month", "day", "borough_name")


def gps_trip_fields(lines: DataFrame, value_col: str = "value",
                    on_bad_timestamp: str = "drop") -> DataFrame:
    """``(pickup_ts, lon, lat)`` for lines that pass validation.

    Longitude (field 5) and latitude (field 6) must read as floats and be
    non-zero; NaN and infinities pass, as they do for Python's ``float``.
    """
    raw = _token_fields(lines, value_col, {"_lon": 5, "_lat": 6})
    coords = raw.select("_n", "_pickup_text", float_value(F.col("_lon")).alias("lon"),
                        float_value(F.col("_lat")).alias("lat"))
    shaped = ((F.col("_n") >= MIN_FIELDS) & F.col("lon").isNotNull() & F.col("lat").isNotNull()
              & (F.col("lon") != 0) & (F.col("lat") != 0))
    checked = coords.select("lon", "lat", shaped.alias("_shaped"),
                            F.when(shaped, _pickup(on_bad_timestamp)).alias("pickup_ts"))
    checked = checked.withColumn("_ok", F.col("_shaped") & F.col("pickup_ts").isNotNull())
    return keep_where(checked, "_ok", ["pickup_ts", "lon", "lat"])


def parse_gps_trips(lines: DataFrame, index, value_col: str = "value",
                    on_bad_timestamp: str = "drop",
                    block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """GPS lines -> ``(assign_date, time_block, month, day, borough_name)``.

    ``index`` is a :class:`tripdemand.operators.spatial.PolygonIndex`.
    """
    pts = gps_trip_fields(lines, value_col, on_bad_timestamp)
    located = index.locate(pts, "lon", "lat")
    return with_time_features(located, "pickup_ts", block_minutes).select(
        F.to_date("pickup_ts").alias("assign_date"), "time_block", "month", "day",
        "borough_name")
