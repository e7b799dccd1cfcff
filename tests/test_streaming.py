"""Incremental ingest: only new files are processed, late rows stay, a batch run again replaces itself."""

import os

from eventmart.operators.etl import run_etl
from eventmart.sources.lake import read_lake
from eventmart.streaming.ingest import start_ingest
from tests.conftest import write_text

HEAD = "timestamp,session_id,action,amount\n"


def _landing(workdir):
    folder = os.path.join(workdir, "landing")
    os.makedirs(folder)
    return folder


def _ids(spark, workdir):
    return sorted(r.session_id for r in read_lake(spark, f"{workdir}/lake").collect())


def test_incremental_ingest(spark, workdir):
    landing = _landing(workdir)
    write_text(landing, "a.csv", HEAD + "2024-01-01 10:00:00,s1, view,1.5\n"
                                        "2024-01-01 10:00:00,s1, view,1.5\n"
                                        "2024-01-01 10:00:00,s1,view ,1.5\n"
                                        "bad,s2,click,2\n")
    start_ingest(spark, landing, f"{workdir}/lake", f"{workdir}/ckpt").awaitTermination()
    rows = read_lake(spark, f"{workdir}/lake").collect()
    assert sorted(r.session_id for r in rows) == ["s1", "s1", "s2"]   # padded copy kept
    assert {r.event_type for r in rows} == {"view", "click"}

    # a second file with another layout, and a row far older than all others
    write_text(landing, "b.csv", "amount;session_id;timestamp;action\n3;s3;2024-01-02 11:00:00;view\n4;A4;2020-05-05 00:00:00;view\n")
    second = start_ingest(spark, landing, f"{workdir}/lake", f"{workdir}/ckpt")
    second.awaitTermination()
    assert sum(p["numInputRows"] for p in second.recentProgress) == 1     # one new file
    assert _ids(spark, workdir) == ["A4", "s1", "s1", "s2", "s3"]
    s3 = [r for r in read_lake(spark, f"{workdir}/lake").collect() if r.session_id == "s3"][0]
    assert (s3.event_date_str, s3.event_hour, s3.price) == ("2024-01-02", 11, 3.0)


def test_stream_and_batch_share_a_lake(spark, workdir):
    landing = _landing(workdir)
    write_text(landing, "a.csv", HEAD + "2024-01-01 10:00:00,s1,view,1\n")
    batch = write_text(workdir, "b.csv", HEAD + "2024-01-01 10:00:00,s2,view,1\n")
    run_etl(spark, batch, f"{workdir}/lake")
    start_ingest(spark, landing, f"{workdir}/lake", f"{workdir}/ckpt").awaitTermination()
    run_etl(spark, batch, f"{workdir}/lake")
    assert _ids(spark, workdir) == ["s1", "s2"]


def test_a_batch_run_again_replaces_itself(spark, workdir):
    landing = _landing(workdir)
    write_text(landing, "a.csv", HEAD + "2024-01-01 10:00:00,s1,view,1\n")
    for k in range(2):                     # a new checkpoint under the same name: batch 0 runs again
        start_ingest(spark, landing, f"{workdir}/lake", f"{workdir}/ckpt{k}", name="clicks").awaitTermination()
    assert _ids(spark, workdir) == ["s1"]
