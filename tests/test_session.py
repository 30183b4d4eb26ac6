import pytest

from tidemark.session import hadoop_path, scratch_dir, scratch_root, size_shuffles, write_new_file


class Named:
    """A session that answers ``spark.checkpoint.dir`` with a given value."""

    def __init__(self, spark, root):
        self.conf, self.sparkContext, self._root = self, spark.sparkContext, root

    def get(self, key, default=None):
        return self._root if key == "spark.checkpoint.dir" else default


def test_scratch_follows_the_checkpoint_setting(spark, tmp_path):
    named = Named(spark, f"{tmp_path}/shared/")
    assert scratch_root(named) == f"{tmp_path}/shared"
    one, two = scratch_dir(named, "x"), scratch_dir(named, "x")
    assert one != two and one.startswith(f"{tmp_path}/shared/x-")
    p, fs = hadoop_path(spark, one)
    assert fs.exists(p)


def test_scratch_without_the_setting(spark, monkeypatch):
    """A local session falls back to a temporary folder; a cluster on local disks is refused."""
    import tidemark.session as session
    monkeypatch.setattr(session, "_configured_root", lambda s: None)
    assert hadoop_path(spark, scratch_root(spark))[1].exists(hadoop_path(spark, scratch_root(spark))[0])

    class Cluster:
        sparkContext = type("C", (), {"master": "yarn"})()
    monkeypatch.setattr(session, "hadoop_path", lambda s, p: hadoop_path(spark, p))
    with pytest.raises(ValueError):
        scratch_root(Cluster())


def test_small_file_is_created_once(spark, tmp_path):
    target = f"{tmp_path}/a/b.json"
    assert write_new_file(spark, target, "first")
    assert not write_new_file(spark, target, "second")
    assert open(target).read() == "first"


def test_shuffle_partitions_follow_the_bytes(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 0) == 2 * spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 100 * 1024 ** 4) == 546134
        assert spark.conf.get("spark.sql.shuffle.partitions") == "546134"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
