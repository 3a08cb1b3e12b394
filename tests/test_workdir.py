from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from harvestry import workdir


def test_written_tables_are_read_back_and_cleaned(spark):
    df = workdir.written(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS s"), "t")
    assert df.count() == 5 and "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
    folder = workdir._app_dir(spark).removeprefix("file:")
    assert any(n.startswith("t-") for n in os.listdir(folder))
    workdir.clean(spark)
    assert not os.path.exists(folder)


def test_the_folder_is_the_clusters_where_it_names_one():
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: "hdfs://shared/dir/" if name == "spark.checkpoint.dir" else default))
    assert workdir.work_dir(named) == "hdfs://shared/dir"


def test_a_cluster_without_a_shared_folder_is_refused():
    for master, refused in (("local[4]", False), ("spark://host:7077", True), ("local-cluster[2,1,1024]", True), ("yarn", True)):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))
        if refused:
            with pytest.raises(RuntimeError):
                workdir.work_dir(session)
        else:
            assert os.path.isdir(workdir.work_dir(session))
