"""Checkpoint folder rules: the cluster's shared folder is used as given; only local
sessions may fall back to a private scratch folder."""

import pytest

from strata.session import checkpoint_root


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d.rstrip("/") + "/app-uuid"


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_existing_checkpoint_dir_is_used_as_root():
    s = _Session("yarn", current="hdfs://nn/shared/ckpt/0c1d-uuid")
    assert checkpoint_root(s) == "hdfs://nn/shared/ckpt"


def test_configured_dir_is_applied_on_a_cluster():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_root(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.getCheckpointDir().startswith("s3a://bucket/ckpt/")


def test_cluster_without_shared_dir_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session("yarn"))


def test_local_session_gets_a_private_folder():
    root = checkpoint_root(_Session("local[4]"))
    assert root and "strata-ckpt-" in root
