from types import SimpleNamespace

import pytest

from tideferry.sources.shared import scratch_path, shared_folder


def session(folder: str | None = None):
    settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs:///warehouse"}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))


def test_the_cluster_names_the_folder():
    assert shared_folder(session("hdfs:///shared/")) == "hdfs:///shared"


def test_without_the_setting_the_warehouse_is_shared():
    assert shared_folder(session()) == "hdfs:///warehouse/_scratch"
    assert scratch_path(session(), "x") != scratch_path(session(), "x")


def test_a_session_with_the_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class _Session:
    """Settings and a master, as far as the shared folder asks for them."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, *default: settings.get(name.replace(".", "_"), *default))})


def test_a_machines_own_warehouse_is_not_shared_by_a_cluster():
    own = {"spark_sql_warehouse_dir": "file:/home/me/spark-warehouse"}
    assert shared_folder(_Session("local[4]", **own)) == "file:/home/me/spark-warehouse/_scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077", **own))
    assert shared_folder(_Session("yarn", spark_checkpoint_dir="hdfs://x/y/", **own)) == "hdfs://x/y"
    assert shared_folder(_Session("yarn", spark_sql_warehouse_dir="s3a://b/w")) == "s3a://b/w/_scratch"
