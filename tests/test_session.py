"""The shared checkpoint folder: read from the session, required on a cluster."""

from types import SimpleNamespace

import pytest

from eventlytics.session import checkpoint_root


def _session(master, conf=None, checkpoint=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf or default),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))


def test_a_cluster_needs_the_setting():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,3000]", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(_session(master))


def test_the_setting_is_read_as_it_is():
    assert checkpoint_root(_session("yarn", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert checkpoint_root(_session("yarn", None, "file:/shared/x")) == "file:/shared/x"
