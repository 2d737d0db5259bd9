"""Shared-storage rules: scratch tables live under the session's checkpoint directory."""

from ledgerlens.session import ensure_checkpoint_dir, scratch_path, shuffle_partitions_for


def test_scratch_tables_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == base  # an existing setting is kept, never replaced
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/tables/")


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(1) == shuffle_partitions_for(8000) == 8000
    assert shuffle_partitions_for(100_000) == 100_000  # 100 TB: 1 GB a reduce task before pruning
