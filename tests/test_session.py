"""Session helpers: UTC pinning, shared checkpoint folder, cluster defaults."""

from tardy import session as S


def test_pin_utc_sets_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    S.pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_root_uses_the_named_folder(spark):
    root = S.checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir() is not None
    assert S.scratch_path(spark, "x").startswith(root + "/")


def test_cluster_defaults_are_sizes_for_large_shuffles():
    d = S.CLUSTER_DEFAULTS
    assert int(d["spark.sql.shuffle.partitions"]) >= 1000
    assert d["spark.sql.adaptive.advisoryPartitionSizeInBytes"].endswith("m")
