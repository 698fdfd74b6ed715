"""Session settings, working folder, configuration."""

import types

import pytest

from medstrata.config import PipelineConfig, batch_id_of
from medstrata.session import pin_session, shared_dir, together, work_dir


def test_working_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(f"{configured}/x-")


def fake(master, checkpoint=None):
    context = types.SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint
    )
    conf = types.SimpleNamespace(get=lambda key, default: default)
    return types.SimpleNamespace(sparkContext=context, conf=conf)


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))
    assert shared_dir(fake("yarn", "hdfs://shared/cp/")) == "hdfs://shared/cp"
    local = fake("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_session_is_pinned_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert pin_session(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_together_returns_in_order_and_raises(spark):
    assert together(spark, lambda: spark.range(3).count(), lambda: 5) == [3, 5]
    assert together(spark) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)


def test_paths_and_batch_id(spark):
    config = PipelineConfig(root="s3a://b/lake", buckets={"claims": 64})
    paths = config.paths("bronze", "claims")
    assert paths.table == "s3a://b/lake/bronze/bronze_claims"
    assert paths.raw == "s3a://b/lake/source/claims"
    assert paths.checkpoint_for("stream").endswith("bronze_claims/stream")
    assert (config.buckets_of("claims"), config.buckets_of("other")) == (64, 16)
    with pytest.raises(ValueError):
        config.paths("copper", "x")
    assert batch_id_of(spark) == "manual"
