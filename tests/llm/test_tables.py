from types import SimpleNamespace

import pytest

from rowloom.llm import tables


def test_written_and_clean(spark):
    df = tables.written(spark.range(5), "five")
    path = tables.shared_dir(spark)
    assert df.count() == 5 and f"{path.removeprefix('file://')}/rowloom/five-" in df.inputFiles()[0]
    assert tables.shared_dir(spark) == path
    tables.clean(spark)
    assert tables.written(spark.range(3), "three").count() == 3


def test_the_cluster_names_the_folder():
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://name/shared/"})
    assert tables.scratch(cluster, "x").startswith("hdfs://name/shared/rowloom/x-")


def test_a_cluster_without_a_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master))
        with pytest.raises(ValueError):
            tables.scratch(cluster, "x")
