"""Replayed messages and the running key."""

from tests.conftest import lines_df
from tripdemand.operators.replay import replay_messages


def test_messages(spark):
    lines = ["  ", "VendorID,tpep_pickup_datetime,x",
             "1,2017-07-06 08:15:30,2017-07-06 08:20:00,1,1.0,1,N,5,7,CSH,9.5,0,0.5,0,0,0.3,10.3",
             "2,2017-7-6 8:15:30,b,c", "3,not a time,b",
             "\t4,2017-07-06 23:59:59,x,1,1.0,1,N,5,7,extra \r"]
    rows = replay_messages(lines_df(spark, lines), "2024-02-01").collect()
    assert len({r.key for r in rows}) == 3
    assert [r.value for r in rows] == [
        "1,2024-02-01 08:15:30,2017-07-06 08:20:00,1,1.0,1,N,5,7",
        "2,2024-02-01 8:15:30,b,c",
        "4,2024-02-01 23:59:59,x,1,1.0,1,N,5,7"]


def test_keys_are_unique_across_partitions(spark):
    df = spark.range(0, 1000, 1, numPartitions=7).selectExpr(
        "concat(id, ',2017-07-06 10:00:', lpad(id % 60, 2, '0'), ',c') as value")
    rows = replay_messages(df, "2024-02-01").collect()
    assert len(rows) == 1000 and len({r.key for r in rows}) == 1000
    assert {r.value.split(",")[0] for r in rows} == {str(i) for i in range(1000)}


def test_one_scan(spark, tmp_dir):
    spark.range(10).selectExpr("concat(id, ',2017-07-06 10:00:00') as value").write.text(f"{tmp_dir}/lines")
    plan = replay_messages(spark.read.text(f"{tmp_dir}/lines"), "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1 and "Exchange" not in plan and "Join" not in plan


def test_leap_seconds_and_bad_pickups(spark):
    lines = ["a,2017-07-06 10:00:60,x", "b,2017-07-06 10:00:61,x", "c,2017-07-06 10:00:62,x", "d,2017-07-06 10:60:00,x", "", "e"]
    got = sorted(r.value for r in replay_messages(lines_df(spark, lines), "2024-02-01").collect())
    assert got == ["a,2024-02-01 10:00:60,x", "b,2024-02-01 10:00:61,x"]
