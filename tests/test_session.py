import pytest

from tallyline import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class Fake:
    def __init__(self, folder, master):
        self.conf = Conf(folder)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_shared_folder_is_the_clusters_own():
    assert session.shared_folder(Fake("hdfs://x/y", "yarn")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        session.shared_folder(Fake(None, "yarn"))


def test_materialize_round_trip(spark):
    df = session.materialize(spark.range(5), "numbers")
    assert df.count() == 5 and session.shared_folder(spark) in df.inputFiles()[0]


def test_scratch_deletes_its_copies_and_no_others(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.scratch(spark):
        inner = session.materialize(spark.range(5), "inner")
        with session.scratch(spark):
            innermost = session.materialize(inner, "innermost").inputFiles()[0]
        assert inner.count() == 5 and not spark._jvm.java.io.File(innermost.removeprefix("file://")).exists()
        gone = inner.inputFiles()[0]
    assert not spark._jvm.java.io.File(gone.removeprefix("file://")).exists()
    assert kept.count() == 3


def test_scratch_deletes_after_an_error(spark):
    with pytest.raises(ValueError):
        with session.scratch(spark):
            path = session.materialize(spark.range(5), "failed").inputFiles()[0]
            raise ValueError
    assert not spark._jvm.java.io.File(path.removeprefix("file://")).exists()
