"""Session settings and the shared checkpoint folder."""

import os

from tickforge.session import checkpoint_root, staging_dir


def test_semantic_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_staging_lives_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert checkpoint_root(spark) == root                      # stable once set
    a, b = staging_dir(spark, "x"), staging_dir(spark, "x")
    assert a != b and a.startswith(os.path.join(root, "staging"))
    assert spark.sparkContext.getCheckpointDir() is not None
