"""Scratch folders come from the session's checkpoint dir; defaults never override."""

import pytest

from tripdemand.session import apply_defaults, fresh_dir, scratch_root


def test_scratch_root_is_the_checkpoint_dir(spark):
    root = scratch_root(spark)
    assert spark.sparkContext.getCheckpointDir().rstrip("/") == root
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(root + "/") and b.startswith(root + "/")


def test_defaults_keep_explicit_settings(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        apply_defaults(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        def contains(self, key):
            return key in self

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())
