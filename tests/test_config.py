"""Settings, paths and the shared work folder."""

from __future__ import annotations

import pytest

from netpulse import EngineConfig, prepare
from netpulse.session import fresh_folder, shared_root, work_folder
from netpulse.sources import folders
from netpulse.sources.records import _kafka_options


def test_detect_switches_between_mount_and_local(spark, tmp_path):
    local = EngineConfig.detect(spark, mount=str(tmp_path / "missing"))
    assert local.bronze == "/tmp/streaming/bronze" and local.checkpoint("bronze") == "/tmp/streaming/checkpoints/bronze"
    assert local.bootstrap_servers == "localhost:9092"
    mounted = EngineConfig.detect(spark, mount=str(tmp_path), checkpoints="/ckpt", table_format="delta")
    assert mounted.silver == f"{tmp_path}/silver" and mounted.checkpoint("silver") == "/ckpt/silver"
    assert mounted.bootstrap_servers == "kafka-broker:9092" and mounted.table_format == "delta"


def test_triggers_keep_their_cadence():
    cfg = EngineConfig.under("/x")
    assert [cfg.trigger(e) for e in (cfg.bronze_every, cfg.silver_every, cfg.alerts_every)] == [
        {"processingTime": "30 seconds"},
        {"processingTime": "60 seconds"},
        {"processingTime": "10 seconds"},
    ]
    assert cfg.but(available_now=True).trigger("30 seconds") == {"availableNow": True}
    assert (cfg.starting_offsets, cfg.fail_on_data_loss, cfg.max_offsets_per_trigger) == ("latest", False, None)


@pytest.mark.parametrize(
    "bad", [{"record_source": "files"}, {"record_source": "carrier pigeon"}, {"alerts_from": "gold"}, {"alert_tier": "all"}]
)
def test_impossible_settings_are_refused(bad):
    with pytest.raises(ValueError):
        EngineConfig.under("/x", **bad)


def test_shared_root_is_the_checkpoint_folder_of_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    one, two = fresh_folder(spark, "a"), fresh_folder(spark, "a")
    assert one != two and one.startswith(shared_root(spark))


def test_work_folders_go_with_their_job(spark):
    with work_folder(spark) as outer:
        kept = fresh_folder(spark, "table")
        spark.range(3).write.parquet(kept)
        with work_folder(spark) as inner:
            spark.range(3).write.parquet(fresh_folder(spark, "table"))
            assert inner.startswith(outer) and len(folders.children(spark, inner)) == 1
        assert kept.startswith(outer) and spark.read.parquet(kept).count() == 3 and not folders.exists(spark, inner)
    assert not folders.exists(spark, outer) and not fresh_folder(spark, "a").startswith(outer)
    with pytest.raises(RuntimeError), work_folder(spark) as failed:
        spark.range(3).write.parquet(fresh_folder(spark, "table"))
        raise RuntimeError
    assert not folders.exists(spark, failed)


def test_prepare_sets_the_method_limit_but_keeps_a_chosen_one_and_the_zone(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert prepare(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert spark.conf.get(key) == "5000"
    spark.conf.set(key, "7000")
    assert prepare(spark).conf.get(key) == "7000"
    spark.conf.unset(key)
    assert prepare(spark).conf.get(key) == "5000"


def test_kafka_partitions_can_be_split():
    cfg = EngineConfig.under("/shared", min_partitions=64)
    assert _kafka_options(cfg)["minPartitions"] == "64"
    assert "minPartitions" not in _kafka_options(cfg.but(min_partitions=None))
