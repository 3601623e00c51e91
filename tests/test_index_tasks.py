"""The polygon index is built by few tasks, whatever the session's number of shuffle partitions."""

from tripdemand.operators.spatial import PolygonIndex
from tripdemand.plans import fixtures as fx
from tripdemand.sources.boroughs import geojson_edges, geojson_text_frame


def test_tasks_of_the_index_do_not_follow_the_shuffle_partitions(spark):
    sc, before = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    sc.setJobGroup("index-tasks", "")
    try:
        index = PolygonIndex(geojson_edges(geojson_text_frame(spark, fx.FIXTURE_GEOJSON)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("index-tasks")]
    stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in j.stageIds]
    tasks = [s.numTasks for s in stages if s and s.numCompletedTasks]
    assert tasks and max(tasks) < 100
    points = spark.createDataFrame([(1.0, 1.0), (15.0, 15.0), (9.0, 9.0)], "x double, y double")
    assert sorted((r.x, r.borough_name) for r in index.locate(points, "x", "y").collect()) == [(1.0, "Manhattan"), (9.0, "EWR"), (15.0, "Bronx")]
