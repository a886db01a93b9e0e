from types import SimpleNamespace

import pytest

from conftest import same
from fleetwane import session


def cluster(**settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))


def test_shared_folder_comes_from_the_session():
    assert session.scratch_dir(cluster(spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        session.scratch_dir(cluster())


def test_stored_table(spark):
    stored = session.store(spark.range(3), "numbers")
    assert same(stored.collect(), [(0,), (1,), (2,)])
    assert all(session.scratch_dir(spark) in f for f in stored.inputFiles())


def test_scope_removes_its_tables(spark):
    with session.scratch_scope(spark) as folder:
        stored = session.store(spark.range(3), "numbers")
        assert all(folder in f for f in stored.inputFiles()) and stored.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(folder)
    assert folder not in session.store(spark.range(1), "numbers").inputFiles()[0]


@pytest.mark.parametrize("rows", [[], [(1, "a", None), (2, None, 0.5)]])
def test_local_table(spark, rows):
    df = session.local_table(spark, rows, "unit bigint, name string, x double")
    assert same(df.collect(), rows)
    assert df.dtypes == [("unit", "bigint"), ("name", "string"), ("x", "double")]
