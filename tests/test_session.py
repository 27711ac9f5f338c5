"""Where intermediate data may go."""

import pytest

from furlong.session import NoSharedFolderError, default_checkpoint_dir


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(NoSharedFolderError, match="spark.checkpoint.dir"):
        default_checkpoint_dir(None, master)
    assert default_checkpoint_dir("hdfs:///ckpt", master) == "hdfs:///ckpt"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_one_machine_may_use_its_own(master):
    assert "furlong-ckpt-" in default_checkpoint_dir("", master)
