"""Streaming: per-batch deltas, restart, late rows, idempotent batch replay."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tripdemand.operators.aggregates import historical_mean, live_counts, trip_counts
from tripdemand.operators.parse import parse_zone_trips
from tripdemand.plans import fixtures as fx
from tripdemand.plans.reports import live_profile, overlay_report
from tripdemand.sources.streams import text_trip_stream
from tripdemand.sources.tables import read_table, write_trip_data, write_trip_stats
from tripdemand.streaming.live import LiveBatch, day_and_month, start_live


@pytest.fixture(scope="module")
def setup(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="run-")
    ev = fx.table(spark, SF0001, "events")
    zones = fx.zones(spark, SF0001)
    # Three message files split by event_id, plus the stats of the whole history.
    lines = fx.zone_lines(ev.withColumn("part", F.col("event_id") % 3))
    src = f"{root}/messages"
    for k in range(3):
        (fx.zone_lines(ev.where(F.col("event_id") % 3 == k)).coalesce(1)
         .write.text(f"{src}/part{k}"))
    wh = f"{root}/warehouse"
    trips = parse_zone_trips(fx.zone_lines(ev), zones)
    write_trip_data(trip_counts(trips), wh)
    write_trip_stats(historical_mean(read_table(spark, wh, "trip_data")), wh)
    return {"root": root, "src": src, "wh": wh, "zones": zones, "trips": trips, "lines": lines}


def run_stream(spark, s, checkpoint, path=None):
    msgs = (spark.readStream.format("text").option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).load(path or s["src"]))
    q = start_live(spark, msgs, s["zones"], s["wh"], fx.REFERENCE_DATE, checkpoint,
                   trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_deltas_sum_to_batch_counts(spark, setup):
    s = setup
    run_stream(spark, s, f"{s['root']}/ckpt")
    log = read_table(spark, s["wh"], "real_trip")
    assert log.select("batch_id").distinct().count() == 3
    assert log.count() == s["trips"].count()
    stats = read_table(spark, s["wh"], "real_trip_stats")
    summed = (stats.groupBy("borough_name", "time_block", "month", "day")
              .agg(F.sum("actual_trips").alias("n")))
    day, month = day_and_month(fx.REFERENCE_DATE)
    hist = (read_table(spark, s["wh"], "trip_stats").where((F.col("day") == day) & (F.col("month") == month))
            .select("borough_name", "time_block"))
    expected = (live_counts(s["trips"]).join(hist, ["borough_name", "time_block"])
                .select("borough_name", "time_block", "month", "day", F.col("actual_trips").alias("n")))
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, expected.collect()))

    # Restart from the same checkpoint: nothing new, totals unchanged.
    before = stats.agg(F.sum("actual_trips")).first()[0]
    run_stream(spark, s, f"{s['root']}/ckpt")
    assert read_table(spark, s["wh"], "real_trip_stats").agg(F.sum("actual_trips")).first()[0] == before

    # A row 400 days late still counts, in its own block, in a new batch.
    late = f"{s['src']}/late"
    os.makedirs(late)
    with open(f"{late}/late.txt", "w") as f:
        f.write("1,2022-11-30 08:15:00,2022-11-30 08:20:00,1,1.0,1,N,1,1\n")
    run_stream(spark, s, f"{s['root']}/ckpt")
    log = read_table(spark, s["wh"], "real_trip")
    assert log.select("batch_id").distinct().count() == 4
    row = log.where(F.col("batch_id") == 3).collect()
    assert len(row) == 1 and row[0].time_block == 49 and row[0].day == "Wednesday"


def test_replayed_batch_overwrites_itself(spark, setup, tmp_dir):
    s = setup
    wh = f"{tmp_dir}/wh"
    write_trip_stats(read_table(spark, s["wh"], "trip_stats"), wh)
    batch = LiveBatch(wh, fx.REFERENCE_DATE, run_id="run-a")
    trips = s["trips"]
    batch(trips, 7)
    first = sorted(map(tuple, read_table(spark, wh, "real_trip_stats").collect()))
    batch(trips, 7)  # replay of the same batch id
    again = sorted(map(tuple, read_table(spark, wh, "real_trip_stats").collect()))
    assert first == again and len(first) > 0
    assert read_table(spark, wh, "real_trip").count() == trips.count()
    LiveBatch(wh, fx.REFERENCE_DATE, run_id="run-b")(trips, 7)  # another run keeps its own rows
    assert read_table(spark, wh, "real_trip").count() == 2 * trips.count()


def test_missing_stats_fail_the_batch(spark, setup, tmp_dir):
    """A batch that has nothing to compare with must be run again, not committed."""
    wh = f"{tmp_dir}/wh"
    with pytest.raises(AnalysisException):
        LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")(setup["trips"], 0)
    write_trip_stats(read_table(spark, setup["wh"], "trip_stats"), wh)
    LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")(setup["trips"], 0)
    assert read_table(spark, wh, "real_trip").count() == setup["trips"].count()
    assert read_table(spark, wh, "real_trip_stats").count() > 0


def test_new_checkpoint_keeps_earlier_rows(spark, setup, tmp_dir):
    wh = f"{tmp_dir}/wh"
    write_trip_stats(read_table(spark, setup["wh"], "trip_stats"), wh)
    for k in range(2):
        run_stream(spark, {**setup, "wh": wh}, f"{tmp_dir}/ckpt{k}", f"{setup['src']}/part{k}")
    log = read_table(spark, wh, "real_trip")
    runs = {r.run_id: r.n for r in log.groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert len(runs) == 2 and all(runs.values())
    assert {r.batch_id for r in log.select("batch_id").distinct().collect()} == {0}


def test_reports_on_live_tables(spark, setup):
    s = setup
    day, month = day_and_month(fx.REFERENCE_DATE)
    rts = read_table(spark, s["wh"], "real_trip_stats")
    prof = live_profile(rts, fx.REPORT_BOROUGH).collect()
    labels = [r.label for r in prof]
    assert labels == sorted(labels) and len(prof) > 0
    over = overlay_report(read_table(spark, s["wh"], "trip_stats"), rts, fx.REPORT_BOROUGH,
                          day, month).collect()
    assert len(over) >= len(prof)
    with pytest.raises(ValueError):
        overlay_report(read_table(spark, s["wh"], "trip_stats"), rts, "X", "Thursdayy", month)


def test_text_stream_source(spark, setup):
    df = text_trip_stream(spark, setup["src"] + "/part0", max_files_per_trigger=1)
    assert df.isStreaming and df.columns == ["value"]


def test_live_join_plan(spark, setup):
    import contextlib
    import io
    df = LiveBatch(setup["wh"], fx.REFERENCE_DATE).compare(setup["trips"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert plan.count("BroadcastHashJoin") >= 2  # zone lookup and the one-day stats
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [isnotnull(day" in plan
    assert "Python" not in plan


def test_gps_parse_runs_on_a_stream(spark, tmp_dir):
    from tripdemand.operators.parse import parse_gps_trips
    ev = fx.table(spark, SF0001, "events")
    fx.gps_lines(ev).write.text(f"{tmp_dir}/gps")
    index = fx.polygon_index(spark)
    stream = spark.readStream.format("text").load(f"{tmp_dir}/gps")
    q = (parse_gps_trips(stream, index).writeStream.format("memory").queryName("gps_live")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    live = sorted(map(tuple, spark.table("gps_live").collect()))
    batch = sorted(map(tuple, parse_gps_trips(fx.gps_lines(ev), index).collect()))
    assert live == batch and len(live) > 900


def stats_job(spark, setup, wh, where="true"):
    write_trip_stats(read_table(spark, setup["wh"], "trip_stats").where(where), wh)


def test_crash_between_the_sinks_shows_no_row(spark, setup, tmp_dir, monkeypatch):
    """The raw rows are written, the statistics or the record are not: readers see neither; the replay shows both once."""
    from tripdemand.sources import live_store
    wh = f"{tmp_dir}/wh"
    stats_job(spark, setup, wh)
    LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")(setup["trips"], 0)
    n = read_table(spark, wh, "real_trip").count()

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(live_store, "append_log", fail)
    with pytest.raises(RuntimeError):
        LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")(setup["trips"], 1)
    assert len(os.listdir(f"{wh}/real_trip")) == 2  # written, not committed
    for name in ("real_trip", "real_trip_stats"):
        assert read_table(spark, wh, name).where("batch_id = 1").isEmpty()
    monkeypatch.undo()
    for _ in range(2):
        LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")(setup["trips"], 1)
    assert read_table(spark, wh, "real_trip").count() == 2 * n
    assert read_table(spark, wh, "real_trip_stats").groupBy("run_id", "batch_id", "borough_name", "time_block", "month", "day").count() \
        .where("count > 1").isEmpty()


def test_compaction_keeps_rows_and_bounds_files(spark, setup, tmp_dir):
    from tripdemand.sources.live_store import compact_run, vacuum
    wh = f"{tmp_dir}/wh"
    stats_job(spark, setup, wh)
    part = setup["trips"].where("time_block % 7 = 0")
    batch = LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")
    for b in range(4):
        batch(part, b)
    LiveBatch(wh, fx.REFERENCE_DATE, run_id="other")(part, 0)

    def rows(name):
        return sorted(map(str, read_table(spark, wh, name).collect()))

    def files():
        return sum(f.endswith(".parquet") for _, _, names in os.walk(f"{wh}/real_trip") for f in names)

    before = {name: rows(name) for name in ("real_trip", "real_trip_stats")}
    profile = live_profile(read_table(spark, wh, "real_trip_stats"), fx.REPORT_BOROUGH).collect()
    reader = read_table(spark, wh, "real_trip")  # started before the compaction
    assert compact_run(spark, wh, "r") == 4 and compact_run(spark, wh, "r") == 0
    assert {name: rows(name) for name in before} == before
    assert live_profile(read_table(spark, wh, "real_trip_stats"), fx.REPORT_BOROUGH).collect() == profile
    assert reader.count() == len(before["real_trip"])
    batch = LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")
    batch(part, 3)  # replays of merged batches change nothing
    batch(part, 4)
    many = files()
    assert vacuum(spark, wh) == {"segments": 0, "log_files": 0}  # within the grace period
    gone = vacuum(spark, wh, grace_seconds=-5)
    assert gone == {"segments": 8, "log_files": 4} and files() < many
    assert len(rows("real_trip")) == len(before["real_trip"]) * 6 // 5
    assert compact_run(spark, wh, "r", segment_rows=part.count() * 2) == 0  # one large, one small: nothing to merge
    assert len(rows("real_trip")) == len(before["real_trip"]) * 6 // 5


def test_stream_compacts_itself(spark, setup, tmp_dir):
    wh = f"{tmp_dir}/wh"
    stats_job(spark, setup, wh)
    msgs = spark.readStream.format("text").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).load(setup["src"])
    q = start_live(spark, msgs, setup["zones"], wh, fx.REFERENCE_DATE, f"{tmp_dir}/ckpt", trigger={"availableNow": True}, compact_every=2)
    q.awaitTermination()
    assert q.exception() is None
    kinds = [r.kind for r in spark.read.parquet(f"{wh}/live_log").collect()]
    assert kinds.count("snapshot") >= 1
    assert read_table(spark, wh, "real_trip").count() >= setup["trips"].count()
    assert read_table(spark, wh, "real_trip").groupBy("batch_id").count().count() == kinds.count("batch")


def test_recompute_between_batches_leaves_one_row_per_block(spark, setup, tmp_dir):
    wh = f"{tmp_dir}/wh"
    stats_job(spark, setup, wh)
    batch = LiveBatch(wh, fx.REFERENCE_DATE, run_id="r")
    batch(setup["trips"], 0)
    raised = read_table(spark, setup["wh"], "trip_stats").withColumn("mean", F.col("mean") + 1)
    write_trip_stats(raised, wh)
    batch(setup["trips"], 1)
    rts = read_table(spark, wh, "real_trip_stats")
    assert rts.select("stats_version").distinct().count() == 2
    assert rts.groupBy("borough_name", "time_block").agg(F.countDistinct("mean").alias("k")).where("k <> 2").isEmpty()
    rows = live_profile(rts, fx.REPORT_BOROUGH).collect()
    assert len({r.label for r in rows}) == len(rows) > 0
    day, month = day_and_month(fx.REFERENCE_DATE)
    new = {r.label: r.mean for r in overlay_report(read_table(spark, wh, "trip_stats"), rts, fx.REPORT_BOROUGH, day, month).collect()}
    assert all(r.mean == new[r.label] for r in rows)
