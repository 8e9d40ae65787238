import types

import pytest

from quernstone.plans import lineage


def _session(master, folder=None):
    conf = types.SimpleNamespace(get=lambda name, default=None: default)
    context = types.SimpleNamespace(master=master, applicationId="app", getConf=lambda: conf, getCheckpointDir=lambda: folder, setCheckpointDir=lambda path: None)
    return types.SimpleNamespace(conf=conf, sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.shared_folder(_session(master))
    assert lineage.shared_folder(_session(master, "hdfs:///c/")) == "hdfs:///c/app"


def test_a_local_session_gets_a_folder_of_its_own():
    assert lineage.shared_folder(_session("local[3]")).startswith("file://")


def test_a_cut_is_read_again_and_dropped(spark):
    held = lineage.Cut(spark.range(3), "numbers")
    assert held.read().count() == 3
    held.drop()
    with pytest.raises(Exception):
        held.read().count()
