"""Session settings: test-sized values only for local sessions."""

import eventmart.session as S


class _Builder:
    def __init__(self, calls):
        self.calls = calls

    def appName(self, name):
        return self

    def master(self, master):
        self.calls.append("master")
        return self

    def config(self, key, value):
        self.calls.append(key)
        return self

    def getOrCreate(self):
        class Context:
            def setLogLevel(self, level):
                pass

        class Session:
            sparkContext = Context()
        return Session()


def _built_with(monkeypatch, submitted: bool) -> list[str]:
    calls: list[str] = []

    class FakeSession:
        builder = _Builder(calls)

    monkeypatch.setattr(S, "SparkSession", FakeSession)
    if submitted:
        monkeypatch.setenv("PYSPARK_GATEWAY_PORT", "1")
    else:
        monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    S.build_session()
    return calls


def test_spark_submit_keeps_cluster_master_and_sizing(monkeypatch):
    calls = _built_with(monkeypatch, submitted=True)
    assert "master" not in calls
    assert "spark.sql.shuffle.partitions" not in calls and "spark.driver.memory" not in calls
    assert "spark.sql.adaptive.enabled" in calls


def test_local_session_is_test_sized(monkeypatch):
    calls = _built_with(monkeypatch, submitted=False)
    assert "master" in calls and "spark.sql.shuffle.partitions" in calls
