from __future__ import annotations

import pytest

from demandgrid.session import CHECKPOINT_DIR, materialize, scratch_path


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class FakeSession:
    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})()


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        scratch_path(FakeSession("spark://host:7077"), "x")
    assert scratch_path(FakeSession("yarn", **{CHECKPOINT_DIR: "hdfs://shared/c"}), "x").startswith("hdfs://shared/c/")


def test_local_master_gets_its_own_folder_once():
    session = FakeSession("local[2]")
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first != second and first.startswith(session.conf[CHECKPOINT_DIR]) and second.startswith(session.conf[CHECKPOINT_DIR])


def test_materialized_frame_reads_files(spark):
    df = materialize(spark.range(10), "numbers")
    assert df.count() == 10 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString() or df.inputFiles()


def test_a_name_is_taken_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    from demandgrid.session import claim

    folder = scratch_path(spark, "claims")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda _: claim(spark, f"{folder}/v1"), range(12)))
    assert sorted(got) == [False] * 11 + [True]
    assert claim(spark, f"{folder}/v2") and not claim(spark, f"{folder}/v2")
