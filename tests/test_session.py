from tagsmith.session import CLUSTER_CONF, ensure_checkpoint_dir


def test_cluster_profile_settings():
    for key, value in [("spark.sql.adaptive.enabled", "true"), ("spark.sql.adaptive.skewJoin.enabled", "true"),
                       ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
                       ("spark.cleaner.referenceTracking.cleanCheckpoints", "true")]:
        assert CLUSTER_CONF[key] == value
    assert "spark.checkpoint.dir" not in CLUSTER_CONF  # must come from the cluster's own configuration


def test_checkpoint_folder_is_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
