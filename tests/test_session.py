import pytest

from marginlens.plans.session import CheckpointDirMissing, ensure_checkpoint_dir


class _Context:
    def __init__(self, master, checkpoint_dir=None):
        self.master, self._dir = master, checkpoint_dir

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


class _Conf:
    def __init__(self, values):
        self._values = values

    def get(self, key, default=None):
        return self._values.get(key, default)


class _Session:
    def __init__(self, master, conf=None, checkpoint_dir=None):
        self.sparkContext = _Context(master, checkpoint_dir)
        self.conf = _Conf(conf or {})


def test_cluster_session_without_checkpoint_dir_is_refused():
    with pytest.raises(CheckpointDirMissing):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used_as_is():
    session = _Session("spark://head:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(session) == "hdfs:///shared/ckpt"
    already = _Session("k8s://api", checkpoint_dir="hdfs:///shared/other")
    assert ensure_checkpoint_dir(already) == "hdfs:///shared/other"


def test_local_session_gets_a_scratch_folder_only_when_unset():
    assert ensure_checkpoint_dir(_Session("local[4]")).split("/")[-1].startswith("marginlens-ckpt-")
    assert ensure_checkpoint_dir(_Session("local[4]", {"spark.checkpoint.dir": "/x"})) == "/x"


def test_real_session_has_a_checkpoint_dir(spark):
    assert ensure_checkpoint_dir(spark)
