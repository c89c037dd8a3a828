"""Shared-folder lookup: read from the session; a local scratch folder only in local mode."""

import types

import pytest

from keytally.session import checkpoint_root


def _stub(master, conf_value=None, context_dir=None):
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir,
                               setCheckpointDir=lambda path: None)
    conf = types.SimpleNamespace(get=lambda key, default=None: conf_value if key == "spark.checkpoint.dir" else default)
    return types.SimpleNamespace(sparkContext=sc, conf=conf)


def test_configured_folder_is_used():
    assert checkpoint_root(_stub("yarn", conf_value="hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"
    assert checkpoint_root(_stub("k8s://x", context_dir="s3a://b/ckpt/uuid")) == "s3a://b/ckpt/uuid"


def test_cluster_without_shared_folder_refuses():
    with pytest.raises(RuntimeError):
        checkpoint_root(_stub("spark://master:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_root(_stub("local-cluster[2,1,1024]"))


def test_local_mode_gets_a_scratch_folder():
    path = checkpoint_root(_stub("local[4]"))
    assert path.startswith("/") and "keytally-ckpt-" in path
