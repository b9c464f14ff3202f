from types import SimpleNamespace

import pytest

from sluicegate import session
from sluicegate.errors import JobError


@pytest.mark.parametrize("master", ["yarn", "spark://a:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_clusters_need_a_shared_folder(master):
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k: None), getCheckpointDir=lambda: None, setCheckpointDir=None)
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(JobError, match="spark.checkpoint.dir"):
        session.scratch_dir(spark, "x")
    with pytest.raises(JobError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(spark)


def test_one_machine_does_not(spark):
    assert session.scratch_dir(spark, "x").endswith(tuple("0123456789abcdef"))
