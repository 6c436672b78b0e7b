from __future__ import annotations

import glob

import pytest

from ridemill.session import checkpointed, scratch_path, shared_root, shuffle_partitions_for


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    assert scratch_path(spark, "x").startswith(f"{named}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_checkpoint_is_written_there(spark):
    before = set(glob.glob(f"{shared_root(spark)}/**/rdd-*", recursive=True))
    frame = checkpointed(spark.range(5))
    assert frame.count() == 5
    after = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/**/rdd-*", recursive=True))
    assert after - before


class Cluster:
    """A session on a cluster, as far as the folder choice looks at it."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_root(Cluster)


def test_shuffle_partitions_follow_the_shuffled_size():
    assert shuffle_partitions_for(1) == 200
    assert shuffle_partitions_for(3 * 2**40) == 12_288
    assert shuffle_partitions_for(3 * 2**40 + 1) == 12_289
