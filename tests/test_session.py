"""The folder of intermediates."""

from types import SimpleNamespace

import pytest

from duelspark.session import shared_root


def session(master, **settings):
    context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name.split(".")[1], default)), sparkContext=context)


def test_named_folder_wins():
    assert shared_root(session("yarn", checkpoint="s3a://lake/tmp/", sql="file:/here")) == "s3a://lake/tmp"


def test_local_warehouse_is_for_local_sessions():
    assert shared_root(session("local[8]", sql="file:/here")) == "file:/here"
    assert shared_root(session("yarn", sql="s3a://lake/warehouse")) == "s3a://lake/warehouse"
    for folder in ("file:/here", "/here"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session("yarn", sql=folder))
