"""The shared folder: named by the session, created for local masters only."""

import pytest

from eventlens import session


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    applicationId, master = "app-x", "spark://host:7077"

    def getCheckpointDir(self):  # noqa: N802
        return None


class _Session:
    sparkContext = _Context()

    def __init__(self, **conf):
        self.conf = _Conf(conf)


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())
    assert session.ensure_checkpoint_dir(_Session(**{"spark.checkpoint.dir": "hdfs://x/c"})) == "hdfs://x/c"


def test_local_sessions_get_a_folder(spark):
    assert session.ensure_checkpoint_dir(spark)
