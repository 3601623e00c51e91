"""Files, zone lookup CSV, sinks and the batch job."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tripdemand.operators.aggregates import historical_mean, trip_counts, union_trips
from tripdemand.operators.parse import parse_gps_trips, parse_zone_trips
from tripdemand.plans import fixtures as fx
from tripdemand.plans.batch import run_batch
from tripdemand.sources.tables import read_table, stats_for_day, write_trip_data, write_trip_stats
from tripdemand.sources.trip_files import (
    classify_files, classify_headers, paths_by_kind, read_trip_csv,
)
from tripdemand.sources.zones import read_zone_lookup

LOOKUP_ROWS = '''"LocationID","Borough","Zone","service_zone"
1,"EWR","Newark Airport","EWR"
2,"Queens","Jamaica Bay","Boro Zone"
4,"Manhattan","Alphabet City","Yellow Zone"
264,"Unknown","NV","N/A"
2,"Brooklyn","Duplicate id, later wins","Boro Zone"
'''


def test_zone_lookup_csv(spark, tmp_dir):
    path = f"{tmp_dir}/zones.csv"
    with open(path, "w") as f:
        f.write(LOOKUP_ROWS)
    got = {r.zone_code: r.borough_name for r in read_zone_lookup(spark, path).collect()}
    assert got == {"1": "EWR", "2": "Brooklyn", "4": "Manhattan", "264": "Unknown"}
    bare = f"{tmp_dir}/zones_no_header.csv"
    with open(bare, "w") as f:
        f.write("\n".join(LOOKUP_ROWS.splitlines()[1:]) + "\n")
    got = {r.zone_code: r.borough_name for r in read_zone_lookup(spark, bare).collect()}
    assert got == {"1": "EWR", "2": "Brooklyn", "4": "Manhattan", "264": "Unknown"}


def test_classify_headers(spark):
    df = spark.createDataFrame(
        [("a", fx.zone_coded_header()), ("b", fx.gps_header()), ("c", ""), ("d", None),
         ("e", "a,b,c,d,e,f,g,h"), ("f", "  " + fx.zone_coded_header() + "\r")],
        "file_path string, header string")
    got = {r.file_path: r.location_type for r in classify_headers(df).collect()}
    assert got == {"a": "TAXIZONE", "b": "GPS", "c": None, "d": None, "e": None, "f": "TAXIZONE"}


def write_files(spark, root):
    ev = fx.table(spark, SF0001, "events")

    def write(name, header, body):
        spark.createDataFrame([(header,)], "value string").unionByName(body) \
            .coalesce(1).write.text(f"{root}/{name}")

    write("yellow_2024_zone", fx.zone_coded_header(), fx.zone_lines(ev))
    write("yellow_2024_gps", fx.gps_header(), fx.gps_lines(ev))
    write("yellow_blank", "", fx.zone_lines(ev))
    write("green_2024", fx.zone_coded_header(), fx.zone_lines(ev))
    return ev


def test_run_batch_end_to_end(spark, tmp_dir):
    root, wh = f"{tmp_dir}/in", f"{tmp_dir}/wh"
    ev = write_files(spark, root)
    zones, index = fx.zones(spark, SF0001), fx.polygon_index(spark)
    kinds = paths_by_kind(classify_files(spark, root))
    assert len(kinds["TAXIZONE"]) == 1 and len(kinds["GPS"]) == 1
    run_batch(spark, root, wh, zones=zones, index=index)

    expected = trip_counts(union_trips(parse_zone_trips(fx.zone_lines(ev), zones),
                                       parse_gps_trips(fx.gps_lines(ev), index)))
    stored = read_table(spark, wh, "trip_data")
    assert sorted(map(tuple, stored.collect())) == sorted(
        map(tuple, expected.select(*stored.columns).collect()))
    stats = read_table(spark, wh, "trip_stats")
    exp_stats = historical_mean(expected)
    assert sorted(map(tuple, stats.collect())) == sorted(
        map(tuple, exp_stats.select(*stats.columns).collect()))

    # Running the same load again changes nothing.
    rows = sorted(map(tuple, stored.collect()))
    run_batch(spark, root, wh, zones=zones, index=index)
    assert sorted(map(tuple, read_table(spark, wh, "trip_data").collect())) == rows

    # A second load that holds stray rows of a stored date adds to them, and only to them.
    day = [r for r in rows if str(r[0]) == "2024-01-04"]
    write_trip_data(spark.createDataFrame(day, stored.schema), wh, "another month")
    twice = sorted((*r[:-1], 2 * r[-1]) if r in day else r for r in rows)
    assert sorted(map(tuple, read_table(spark, wh, "trip_data").collect())) == twice


def test_run_batch_checks_its_dimensions(spark, tmp_dir):
    root = f"{tmp_dir}/in"
    write_files(spark, root)
    with pytest.raises(ValueError, match="zone lookup"):
        run_batch(spark, root, f"{tmp_dir}/wh", index=fx.polygon_index(spark))
    with pytest.raises(ValueError, match="polygon index"):
        run_batch(spark, root, f"{tmp_dir}/wh", zones=fx.zones(spark, SF0001))


def test_stats_are_replaced_as_a_whole(spark, tmp_dir):
    """A reader that started on one version finishes on it; a version that was not completed is not seen."""
    wh = f"{tmp_dir}/wh"
    counts = trip_counts(parse_zone_trips(fx.zone_lines(fx.table(spark, SF0001, "events")), fx.zones(spark, SF0001)))
    write_trip_stats(historical_mean(counts), wh)
    before = read_table(spark, wh, "trip_stats")
    n = before.count()
    write_trip_stats(historical_mean(counts).where("day = 'Monday'"), wh)
    assert before.count() == n
    now = read_table(spark, wh, "trip_stats")
    assert 0 < now.count() < n
    read_table(spark, wh, "trip_stats").limit(1).write.partitionBy("month", "day") \
        .parquet(f"{wh}/trip_stats/version=99999999999999999999-broken")
    assert read_table(spark, wh, "trip_stats").count() == now.count()


def test_trip_csv_scan(spark, tmp_dir):
    root = f"{tmp_dir}/in"
    write_files(spark, root)
    kinds = paths_by_kind(classify_files(spark, root))
    zone = read_trip_csv(spark, kinds["TAXIZONE"], "TAXIZONE")
    gps = read_trip_csv(spark, kinds["GPS"], "GPS")
    assert zone.count() == 1000 and gps.count() == 1000
    short = zone.where(F.col("passenger_count").isNull()).count()
    assert short == len([i for i in range(1000) if i % 97 == 0])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        gps.select("pickup_longitude").explain()
    assert "ReadSchema: struct<pickup_longitude:string>" in buf.getvalue()


def test_stats_for_day_prunes_partitions(spark, tmp_dir):
    wh = f"{tmp_dir}/wh"
    ev = fx.table(spark, SF0001, "events")
    counts = trip_counts(parse_zone_trips(fx.zone_lines(ev), fx.zones(spark, SF0001)))
    write_trip_stats(historical_mean(counts), wh)
    df = stats_for_day(spark, wh, "Thursday", "January")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [isnotnull(month" in plan
    assert df.count() == historical_mean(counts).where(
        (F.col("day") == "Thursday") & (F.col("month") == "January")).count()


def test_trip_file_writer_bounds_lines_per_file(spark, tmp_dir, monkeypatch):
    """Several files per kind, each headed by its own header line."""
    monkeypatch.setattr(fx, "LINES_PER_FILE", 300)
    ev = fx.table(spark, SF0001, "events")
    fx.write_trip_files(spark, tmp_dir, "yellow_z", fx.zone_coded_header(),
                        fx.zone_lines(ev, keep_id=True))
    files = (spark.read.text(f"{tmp_dir}/yellow_z")
             .select(F.col("_metadata.file_path").alias("f"), "value"))
    per_file = {r.f: r.n for r in files.groupBy("f").agg(F.count("*").alias("n")).collect()}
    assert len(per_file) == 4 and sum(per_file.values()) == 1000 + 4
    assert max(per_file.values()) <= 300 + 1
    kinds = paths_by_kind(classify_files(spark, tmp_dir))
    assert len(kinds["TAXIZONE"]) == 4 and not kinds["GPS"]


def test_headers_of_many_files_in_one_job(spark, tmp_dir):
    """2,000 files: one listing and one reading job, and the labels of the rule."""
    import os
    from tripdemand.sources.trip_files import header_lines, list_trip_files
    os.makedirs(f"{tmp_dir}/in")
    for k in range(2000):
        with open(f"{tmp_dir}/in/yellow_{k:04d}.csv", "w") as f:
            f.write(["", fx.zone_coded_header() + "\n1,2\n", fx.gps_header() + "\n3,4\n", "\n5,6\n"][k % 4])
    paths = list_trip_files(spark, f"{tmp_dir}/in")
    assert len(paths) == 2000
    sc = spark.sparkContext
    sc.setJobGroup("headers", "first lines")
    heads = header_lines(spark, paths)
    jobs = sc.statusTracker().getJobIdsForGroup("headers")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2
    kinds = {r.file_name: r.location_type for r in classify_headers(heads).collect()}
    assert kinds == {f"yellow_{k:04d}.csv": [None, "TAXIZONE", "GPS", None][k % 4] for k in range(2000)}


def test_moments_follow_the_loads(spark, tmp_dir):
    """Refreshed statistics equal the recompute after a new load, a shared date, a replaced load and a missed refresh."""
    from tripdemand.operators.aggregates import demand_rounded_mean, demand_stdev, stats_from_moments
    from tripdemand.schemas import STATS_KEYS
    from tripdemand.sources.tables import current_loads, moments_change, refresh_moments
    wh = f"{tmp_dir}/wh"
    ev = fx.table(spark, SF0001, "events")
    counts = trip_counts(parse_zone_trips(fx.zone_lines(ev), fx.zones(spark, SF0001)))

    def check():
        data = read_table(spark, wh, "trip_data")
        want = historical_mean(data).join(demand_stdev(data), STATS_KEYS).join(demand_rounded_mean(data), STATS_KEYS)
        got = stats_from_moments(refresh_moments(spark, wh)).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    write_trip_data(counts.where("assign_date < '2024-01-08'"), wh, "a")
    check()
    write_trip_data(counts.where("assign_date >= '2024-01-06'"), wh, "b")  # shares two dates with a
    check()
    write_trip_data(counts.where("assign_date < '2024-01-04'"), wh, "a")  # replaced by fewer dates
    write_trip_data(counts.where("assign_date = '2024-01-02'"), wh, "c")  # and no refresh between
    check()
    versions = len(spark.read.parquet(f"{wh}/trip_moments_versions").collect())
    check()  # nothing changed: no new state
    assert len(spark.read.parquet(f"{wh}/trip_moments_versions").collect()) == versions == 3
    # Only the folders of the new load's dates are read.
    known = current_loads(spark, wh)
    write_trip_data(counts.where("assign_date = '2024-01-09'"), wh, "d")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        moments_change(spark, wh, known, current_loads(spark, wh)).explain()
    assert "PartitionFilters: [" in buf.getvalue() and "assign_date" in buf.getvalue().split("PartitionFilters: [")[1][:200]


def test_duplicate_keys_fail_the_load(spark, tmp_dir):
    from tripdemand.sources.tables import DuplicateKey
    wh = f"{tmp_dir}/wh"
    ev = fx.table(spark, SF0001, "events")
    counts = trip_counts(parse_zone_trips(fx.zone_lines(ev), fx.zones(spark, SF0001)))
    write_trip_data(counts, wh, "a")
    before = read_table(spark, wh, "trip_data").count()
    with pytest.raises(DuplicateKey, match="2024-01-0"):
        write_trip_data(counts.unionByName(counts.limit(1)), wh, "a")
    assert read_table(spark, wh, "trip_data").count() == before  # the earlier generation still counts
    stats = historical_mean(counts)
    write_trip_stats(stats, wh)
    with pytest.raises(DuplicateKey, match="Monday"):
        write_trip_stats(stats.unionByName(stats.where("day = 'Monday'").limit(1)), wh)
    assert read_table(spark, wh, "trip_stats").count() == stats.count()
