"""The two live tables, committed together and compacted.

A micro-batch writes one folder (a segment) per live table and then one record
to the log of its run; readers take the segments that the log names, so a
batch shows in both tables or in neither. A batch that its run's log already holds is
not written again: a replay after a failure is a no-op.

A run has one writer (its stream) and a log of its own, so nothing competes.
Compaction rewrites a run's small segments as one, sorted by date in files of
bounded rows, and records a snapshot: the run's segments from then on. Readers
use the last snapshot and the batches after it. Segments and records that
no snapshot needs any more are deleted by ``vacuum`` after a grace period for
readers that started before.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripdemand.sources.tables import TABLE_SCHEMAS, append_log, conform, read_log, table_path

LIVE_TABLES = ("real_trip", "real_trip_stats")
LOG = "live_log"
LOG_SCHEMA = ("run_id string, batch_id long, at long, kind string, stats_version string,"
              " segments array<struct<name:string,n_rows:long>>")
# Rows of a file and of a segment that compaction leaves alone.
FILE_ROWS, SEGMENT_ROWS = 5_000_000, 50_000_000


class RunState:
    """The segments of one run that count, and its last batch that a snapshot covers."""

    def __init__(self, rows: list):
        snapshots = [r for r in rows if r.kind == "snapshot"]
        last = max(snapshots, key=lambda r: (r.batch_id, r.at), default=None)
        self.covered = last.batch_id if last else None
        batches = {r.batch_id: r for r in rows if r.kind == "batch" and (last is None or r.batch_id > last.batch_id)}
        self.batches = set(batches)
        self.segments = [(s.name, s.n_rows) for r in ([last] if last else []) + [batches[b] for b in sorted(batches)] for s in r.segments]
        self.last_batch = max([*batches, *([last.batch_id] if last else [])], default=None)

    def holds(self, batch_id: int) -> bool:
        return batch_id in self.batches or (self.covered is not None and batch_id <= self.covered)


def run_states(spark: SparkSession, root: str) -> dict[str, RunState]:
    by_run: dict[str, list] = {}
    for r in read_log(spark, root, LOG, LOG_SCHEMA):
        by_run.setdefault(r.run_id, []).append(r)
    return {run: RunState(rows) for run, rows in by_run.items()}


def run_state(spark: SparkSession, root: str, run_id: str) -> RunState:
    return RunState([r for r in read_log(spark, root, LOG, LOG_SCHEMA) if r.run_id == run_id])


def read_segments(spark: SparkSession, root: str, name: str, segments: list[str]) -> DataFrame:
    paths = [f"{table_path(root, name)}/segment={s}" for s in segments]
    if not paths:
        return spark.createDataFrame([], TABLE_SCHEMAS[name])
    return conform(spark.read.schema(TABLE_SCHEMAS[name]).parquet(*paths), name)


def read_live(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All committed rows of a live table."""
    return read_segments(spark, root, name, [s for state in run_states(spark, root).values() for s, _ in state.segments])


def commit_batch(spark: SparkSession, root: str, run_id: str, batch_id: int, frames: dict[str, DataFrame],
                 stats_version: str | None = None, state: RunState | None = None) -> bool:
    """Write a batch's rows of both tables, then its record; False if the log holds the batch already.

    ``state`` is what the run's writer knows of its log (read here if not given). The raw log
    is written as it is partitioned (clustering it would put a batch in one task). The key of
    ``real_trip_stats`` holds by construction: counts grouped by it, joined with statistics
    whose key was checked when they were committed.
    """
    state = state or run_state(spark, root, run_id)
    if state.holds(batch_id):
        return False
    segment = f"{batch_id}-{uuid.uuid4().hex[:12]}"
    rows = Observation()
    for name in LIVE_TABLES:
        keyed = frames[name].withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        if name == "real_trip":
            keyed = keyed.observe(rows, F.count(F.lit(1)).alias("n"))
        else:
            keyed = keyed.withColumn("stats_version", F.lit(stats_version).cast("string"))
        conform(keyed, name).write.parquet(f"{table_path(root, name)}/segment={segment}")
    append_log(spark, root, LOG, LOG_SCHEMA, (run_id, batch_id, time.time_ns(), "batch", stats_version, [(segment, rows.get["n"])]))
    state.batches.add(batch_id)
    return True


def compact_run(spark: SparkSession, root: str, run_id: str, file_rows: int = FILE_ROWS, segment_rows: int = SEGMENT_ROWS) -> int:
    """Merge the run's segments below ``segment_rows`` rows into one; how many were merged.

    Call it from the run's own writer (``LiveBatch`` does every ``compact_every`` batches) or
    while the run is stopped.
    """
    state = run_state(spark, root, run_id)
    small = [s for s, n in state.segments if n < segment_rows]
    if len(small) < 2:
        return 0
    segment = f"merged-{state.last_batch}-{uuid.uuid4().hex[:12]}"
    for name in LIVE_TABLES:
        rows = read_segments(spark, root, name, small)
        # Ranges of dates and blocks: a report's date filter skips files by their statistics.
        rows.repartitionByRange("assign_date", "time_block", "borough_name").sortWithinPartitions("assign_date", "time_block") \
            .write.option("maxRecordsPerFile", file_rows).parquet(f"{table_path(root, name)}/segment={segment}")
    kept = [(s, n) for s, n in state.segments if n >= segment_rows]
    merged = (segment, sum(n for _, n in state.segments if n < segment_rows))
    append_log(spark, root, LOG, LOG_SCHEMA, (run_id, state.last_batch, time.time_ns(), "snapshot", None, [*kept, merged]))
    return len(small)


def vacuum(spark: SparkSession, root: str, grace_seconds: float = 86_400.0) -> dict[str, int]:
    """Delete segments that no record needs and log files that a later snapshot replaces, older than the grace period.

    Uses the file system of the warehouse through the session's JVM (not available on Spark Connect).
    Returns how many of each were deleted. A segment of a batch that is being written is
    younger than any sensible grace period.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = (time.time() - grace_seconds) * 1000
    gone = {"segments": 0, "log_files": 0}

    def listed(path: str):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return fs, list(fs.listStatus(p)) if fs.exists(p) else []

    live = {s for state in run_states(spark, root).values() for s, _ in state.segments}
    for name in LIVE_TABLES:
        fs, entries = listed(table_path(root, name))
        for e in entries:
            segment = e.getPath().getName().removeprefix("segment=")
            if e.isDirectory() and segment not in live and e.getModificationTime() <= before:
                gone["segments"] += bool(fs.delete(e.getPath(), True))
    # A log file is one record; those at or below the batch of a later snapshot of their run are not read any more.
    rows = spark.read.schema(LOG_SCHEMA).parquet(table_path(root, LOG)).select(
        "run_id", "batch_id", "at", "kind", F.col("_metadata.file_path").alias("path")).collect() if live else []
    last: dict[str, tuple] = {}
    for r in rows:
        if r.kind == "snapshot":
            last[r.run_id] = max(last.get(r.run_id, (-1, -1)), (r.batch_id, r.at))
    for r in rows:
        covered = r.run_id in last and ((r.batch_id, r.at) < last[r.run_id] if r.kind == "snapshot" else r.batch_id <= last[r.run_id][0])
        if covered and r.at / 1e6 <= before:
            p = jvm.org.apache.hadoop.fs.Path(r.path)
            gone["log_files"] += bool(p.getFileSystem(conf).delete(p, False))
    return gone
