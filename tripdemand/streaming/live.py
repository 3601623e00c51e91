"""The live micro-batch job.

``messages`` is any streaming DataFrame with a ``value`` column holding a
raw zone-coded trip line (Kafka, a text folder, or a derived stream).
Each micro-batch is parsed, logged to ``real_trip`` and counted per
(borough, block, month, weekday); the counts are joined with the
historical means of the reference weekday/month and written to
``real_trip_stats``. Both are committed by one record (``sources.live_store``):
a batch shows in both tables or in neither, a replayed batch (after a failure,
from the checkpoint) is known by its run and id and changes nothing, and a run
with a new checkpoint, whose batch ids start at 0 again, has rows of its own. Every
``compact_every`` batches the run's small segments are merged. Counts
are per-batch deltas; readers sum them (T4). Each row names the version of the
statistics its batch was compared with, so means that are recomputed while the
stream runs do not split a block in two. There is no watermark: a late
trip counts in whichever batch it arrives (T5). A batch without statistics
to compare with fails, so that it is run again instead of being lost.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripdemand.operators.aggregates import live_counts
from tripdemand.operators.joins import broadcast_if_bounded
from tripdemand.operators.parse import parse_zone_trips
from tripdemand.schemas import BLOCK_MINUTES, ZONE_FIELD
from tripdemand.session import context, scratch_root
from tripdemand.sources.live_store import commit_batch, compact_run, run_state
from tripdemand.sources.tables import current_stats_version, one_day, read_stats_version, stats_for_day

LIVE_INTERVAL = "60 seconds"
# Stats of one weekday and month: at most 144 blocks x a handful of boroughs.
STATS_BROADCAST_ROWS = 1_000_000
# Four times an hour at the default trigger.
COMPACT_EVERY = 15


def day_and_month(reference_date: str | _dt.date) -> tuple[str, str]:
    """F8: weekday and month names of a date (``YYYY-MM-DD``)."""
    d = (reference_date if isinstance(reference_date, _dt.date)
         else _dt.datetime.strptime(reference_date, "%Y-%m-%d").date())
    return d.strftime("%A"), d.strftime("%B")


def stream_run_id(spark: SparkSession) -> str | None:
    """The id of the stream whose batch is running: kept in its checkpoint, new with a new one."""
    sc = context(spark)
    return sc.getLocalProperty("sql.streaming.queryId") if sc is not None else None


class LiveBatch:
    """The per-micro-batch work (T2), usable with ``foreachBatch``.

    It holds no session (the batch's own one is used), so it also pickles
    for Spark Connect's server-side ``foreachBatch``.
    """

    def __init__(self, warehouse: str, reference_date,
                 stats_fmt: str = "parquet", stats_options: dict | None = None,
                 preview: bool = False, run_id: str | None = None, compact_every: int = 0):
        self.run_id = run_id
        self.warehouse = warehouse
        self.day, self.month = day_and_month(reference_date)
        self.stats_fmt, self.stats_options = stats_fmt, stats_options
        self.preview = preview
        self.compact_every = compact_every
        self._stats: tuple = (None, None)  # a version and its day, sized once
        self._run: tuple = (None, None)    # the run and what its log holds (a run has one writer)

    def stats_version(self, spark: SparkSession) -> str | None:
        """The version a batch starting now is compared with (None: another connector, which has no versions)."""
        return current_stats_version(spark, self.warehouse) if self.stats_fmt == "parquet" else None

    def compare(self, trips: DataFrame, version: str | None = None) -> DataFrame:
        """J3 + A3: the batch's counts joined with the reference day's means of a version (default: the current one).

        A re-run of the mean job shows up in the next batch; the one-day read prunes to a single partition folder.
        """
        spark = trips.sparkSession
        version = version or self.stats_version(spark)
        known, stats = self._stats
        if version is None or known != (spark, version):
            stats = (one_day(read_stats_version(spark, self.warehouse, version), self.day, self.month) if version
                     else stats_for_day(spark, self.warehouse, self.day, self.month, self.stats_fmt, self.stats_options))
            stats = broadcast_if_bounded(stats, STATS_BROADCAST_ROWS)
            self._stats = ((spark, version), stats)
        return live_counts(trips).join(stats, ["borough_name", "time_block"], "inner")

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_stats": (None, None), "_run": (None, None)}

    def __call__(self, trips: DataFrame, batch_id: int) -> None:
        spark = trips.sparkSession
        run_id = self.run_id or stream_run_id(spark)
        if not run_id:
            raise ValueError("outside a stream a run_id must be given")
        trips = trips.persist()
        try:
            if self.preview:
                trips.limit(10).show(truncate=False)  # S15, off by default
            version = self.stats_version(spark)
            if self._run[0] != run_id:
                self._run = (run_id, run_state(spark, self.warehouse, run_id))
            commit_batch(spark, self.warehouse, run_id, batch_id, {
                "real_trip": trips.withColumn("assign_date", F.to_date("pickup_ts")),
                "real_trip_stats": self.compare(trips, version)}, version, self._run[1])
        finally:
            trips.unpersist()
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            compact_run(spark, self.warehouse, run_id)
            self._run = (None, None)


def start_live(spark: SparkSession, messages: DataFrame, zones: DataFrame, warehouse: str,
               reference_date, checkpoint: str, trigger: dict | None = None,
               zone_field: int = ZONE_FIELD, on_bad_timestamp: str = "drop",
               block_minutes: int = BLOCK_MINUTES, query_name: str | None = None,
               stats_fmt: str = "parquet", stats_options: dict | None = None,
               preview: bool = False, run_id: str | None = None,
               compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """L2: start the live job; returns the running :class:`StreamingQuery`.

    ``trigger`` defaults to a 60-second processing-time trigger (T1); tests
    pass ``{"availableNow": True}``. ``checkpoint`` must be a shared folder.
    ``run_id`` defaults to the stream's id, which the checkpoint keeps;
    ``preview`` prints ten trips of each batch (S15); ``compact_every`` batches the run is compacted (0: never).
    """
    # The zone dimension is the static side of a stream-static join, which
    # Spark re-evaluates every micro-batch; materialise it once as a
    # reliable checkpoint (this also removes expressions streaming plans
    # reject, such as the file-order id used to resolve duplicate ids).
    scratch_root(spark)
    zones = zones.checkpoint(eager=True)
    trips = parse_zone_trips(messages, zones, zone_field=zone_field,
                             on_bad_timestamp=on_bad_timestamp, block_minutes=block_minutes)
    writer = (trips.writeStream
              .foreachBatch(LiveBatch(warehouse, reference_date, stats_fmt, stats_options,
                                     preview, run_id, compact_every))
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"processingTime": LIVE_INTERVAL})))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
