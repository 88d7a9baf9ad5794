import os

import pytest

from aeris.session import (CHECKPOINT_CONF, CLUSTER_CONF, apply_cluster_conf, ensure_checkpoint_dir, materialize,
                           remove_paths, scratch_path)


def test_scratch_and_materialize_use_the_session_checkpoint_dir(spark):
    base = spark.conf.get(CHECKPOINT_CONF)
    assert base
    path = scratch_path(spark, "probe")
    assert path.startswith(base.rstrip("/") + "/aeris/probe-")
    df = spark.range(10).withColumnRenamed("id", "k")
    back = materialize(df, "probe")
    assert back.count() == 10
    files = back.inputFiles()
    assert files and all(base.rstrip("/").lstrip("/") in f for f in files)


def test_cluster_conf_applies_and_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "16"})
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == CLUSTER_CONF["spark.sql.files.maxPartitionBytes"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for key in CLUSTER_CONF:
        if key.startswith("spark.sql.") and key != "spark.sql.shuffle.partitions":
            spark.conf.unset(key)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(Session())


def test_lineage_cuts_can_be_removed(spark):
    kept = []
    df = materialize(spark.range(3), "gone", kept)
    assert df.count() == 3 and len(kept) == 1
    folder = kept[0]
    remove_paths(spark, kept)
    assert not os.path.exists(folder) and kept == []
