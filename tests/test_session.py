"""The shared folder: never a machine-local one on a cluster."""

from types import SimpleNamespace

import pytest

from panelcast import session


def _session(master, folder=None):
    made = {}
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made.get("dir"), setCheckpointDir=lambda d: made.update(dir=d),
                         getConf=lambda: SimpleNamespace(get=lambda k, d=None: folder))
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None, set=lambda k, v: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_session(master))
    assert session.ensure_checkpoint_dir(_session(master, "hdfs://shared/x")) == "hdfs://shared/x"


def test_local_session_gets_a_temporary_folder():
    assert "panelcast-ckpt-" in session.ensure_checkpoint_dir(_session("local[4]"))
