"""Turn historical trip lines into live messages.

Blank lines and lines whose pickup field is not a timestamp are skipped;
the pickup date is moved to ``replay_date`` keeping the time of day; the
first nine fields are re-joined; each message gets a unique number as its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.functions.time import parse_pickup, rebase_pickup_text
from tripdemand.operators.parse import keep_where

MESSAGE_FIELDS = 9


def replay_messages(lines: DataFrame, replay_date: str, value_col: str = "value") -> DataFrame:
    """``(key STRING, value STRING)`` messages, ready for a Kafka sink.

    One pass over the input: the key is unique and rises within each input
    partition, but is not consecutive across them. Seconds 60 and 61 are
    timestamps here, as the original producer's parser took them.
    """
    text = F.regexp_replace(F.col(value_col), r"^\s+|\s+$", "")
    split = lines.select(text.alias("_t")).select("_t", F.split("_t", ",", -1).alias("_f"))
    fields = split.select("_t", "_f", F.get(F.col("_f"), F.lit(1)).alias("_p"))
    # The time of day is the text after the first single space; a pickup
    # whose date and time are separated otherwise (a tab) is skipped here,
    # where the original producer stopped with an error.
    ok = ((F.length("_t") > 0) & parse_pickup(F.regexp_replace("_p", ":6[01]$", ":59")).isNotNull()
          & (F.size(F.split("_p", " ", -1)) >= 2))
    kept = keep_where(fields.select("_f", "_p", ok.alias("_ok")), "_ok", ["_f", "_p"])
    new_pickup = rebase_pickup_text(F.col("_p"), F.lit(replay_date))
    rebuilt = F.concat(F.array(F.get(F.col("_f"), F.lit(0)), new_pickup),
                       F.slice("_f", 3, MESSAGE_FIELDS - 2))
    msgs = kept.select(F.array_join(rebuilt, ",").alias("value"))
    return msgs.select(F.monotonically_increasing_id().cast("string").alias("key"), "value")
