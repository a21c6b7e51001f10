import pytest

from tablehaul.sources import files


class FakeConf(dict):
    def get(self, name, default=None):
        return dict.get(self, name, default)


class FakeSession:
    def __init__(self, master, **conf):
        self.conf = FakeConf(conf)
        self.sparkContext = type("C", (), {"master": master, "applicationId": f"app-{id(self)}"})()


def test_shared_folder_comes_from_the_session():
    session = FakeSession("spark://h:7077", **{"spark.checkpoint.dir": "hdfs://n/ck/"})
    assert files.work_dir(session) == "hdfs://n/ck"
    assert files.fresh_path(session, "x").startswith(f"hdfs://n/ck/tablehaul/{session.sparkContext.applicationId}/x-")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        files.work_dir(FakeSession("spark://h:7077"))


def test_local_session_gets_its_own_folder():
    session = FakeSession("local[2]")
    assert files.work_dir(session) == files.work_dir(session)


def test_staged_rows_come_back(spark, keyed):
    df = keyed(range(10))
    assert sorted(r["k"] for r in files.staged(df, "t").collect()) == list(range(10))


def test_own_stage_can_be_cleared(spark, keyed, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "work_dir", lambda spark: str(tmp_path))
    files.staged(keyed(range(10)), "t")
    assert list(tmp_path.glob("tablehaul/*/t-*"))
    files.clear_work(spark)
    assert not list(tmp_path.glob("tablehaul/*"))


def test_size_estimate(spark, table):
    assert files.source_bytes(table("orders")) > 1000
