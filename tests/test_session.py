import os
from types import SimpleNamespace

import pytest

from loomline import session


def fake(master, conf):
    return SimpleNamespace(
        sparkContext=SimpleNamespace(master=master),
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
    )


def test_the_configured_folder_is_used():
    assert session.shared_dir(fake("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_dir(fake("spark://master", {}))


def test_local_mode_falls_back_to_one_temporary_folder():
    local = fake("local[2]", {})
    assert session.shared_dir(local) == session.shared_dir(local)
    assert session.workspace(local, "a") != session.workspace(local, "a")


def test_paths_without_a_scheme_mean_the_default_file_system(spark, monkeypatch):
    from loomline import session as ours
    assert ours.qualified(spark, "s3a://a/b") == "s3a://a/b"
    assert ours.qualified(spark, "/tmp/x") == "/tmp/x"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.store.link./in", "file:///tmp")
    conf.set("fs.defaultFS", "viewfs://store/")
    try:
        assert ours.qualified(spark, "/in/x") == "viewfs://store/in/x"
    finally:
        conf.set("fs.defaultFS", before)
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[2,1,512]")
    with pytest.raises(ValueError, match="scheme"):
        ours.qualified(spark, "/tmp/x")
    assert ours.qualified(spark, "file:///tmp/x") == "file:///tmp/x"


def test_workspace_folders_can_be_discarded(spark):
    from loomline import session as ours
    table = ours.write_once(spark.range(3), "kept")
    path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(path)
    ours.discard(spark, path)
    assert not os.path.isdir(path)


def test_the_shared_folder_needs_no_scheme_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[2,1,512]")
    shared = session.shared_dir(spark)
    assert not shared.startswith("file:")
    path = session.workspace(spark, "tokens")
    assert session.qualified(spark, path) == path
    for outside in (f"{shared}-other/x", f"{shared}/../x"):
        with pytest.raises(ValueError, match="scheme"):
            session.qualified(spark, outside)
