"""Command line over a small dirty file; missing input fails loudly."""

import pytest
from pyspark.errors import AnalysisException

from eventmart.cli import main
from eventmart.operators.etl import run_etl
from tests.conftest import write_text
from tests.test_etl import DIRTY


def test_cli_commands(spark, workdir, capsys):
    src = write_text(workdir, "in.csv", DIRTY)
    lake, store = f"{workdir}/lake", f"{workdir}/store"
    assert main(["etl", "--input", src, "--lake", lake], spark=spark) == 0
    assert "rows_written: 5" in capsys.readouterr().out
    main(["build-marts", "--lake", lake, "--store", store], spark=spark)
    assert "daily_metrics" in capsys.readouterr().out
    main(["query", "--lake", lake, "--name", "revenue_by_category", "--csv", f"{workdir}/csv"],
         spark=spark)
    assert "Trousers" in capsys.readouterr().out
    main(["job", "--lake", lake], spark=spark)
    out = capsys.readouterr().out
    assert "event_count_by_type" in out and "skipped" not in out.split("event_count_by_type")[1][:40]
    main(["report", "--lake", lake, "--store", store], spark=spark)
    assert "== top_countries" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(f"{workdir}/csv/revenue_by_category").count() == 3


def test_missing_input_fails(spark, workdir):
    with pytest.raises(AnalysisException):
        run_etl(spark, f"{workdir}/does-not-exist.csv", f"{workdir}/lake")


def test_cli_ingest(spark, workdir):
    import os
    from eventmart.sources.lake import read_lake
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    first = write_text(landing, "a.csv", DIRTY)
    args = ["ingest", "--landing", landing, "--lake", f"{workdir}/lake", "--checkpoint", f"{workdir}/ckpt"]
    assert main(args, spark=spark) == 0
    streamed = read_lake(spark, f"{workdir}/lake").drop("source_id")
    batch_lake = f"{workdir}/batch"
    run_etl(spark, first, batch_lake)
    batch = read_lake(spark, batch_lake).select(*streamed.columns)
    assert streamed.count() == 5
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_cli_report_and_sql_write_whole_results(spark, workdir, capsys):
    import os
    body = "timestamp,session_id,country\n" + "".join(f"2024-{1 + i // 28:02d}-{1 + i % 28:02d} 10:00:00,s{i},PL\n" for i in range(60))
    lake = f"{workdir}/lake"
    run_etl(spark, write_text(workdir, "in.csv", body), lake)
    main(["report", "--lake", lake, "--csv", f"{workdir}/report"], spark=spark)
    out = capsys.readouterr().out
    assert "== categories (skipped" in out and "== top_countries\n" in out
    assert spark.read.option("header", True).csv(f"{workdir}/report/daily_volume").count() == 60
    os.makedirs(f"{workdir}/sql")
    write_text(f"{workdir}/sql", "days.sql", "SELECT event_date_str, COUNT(*) AS n\nFROM events GROUP BY 1;")
    write_text(f"{workdir}/sql", "none.sql", "SELECT country FROM events WHERE country = 'XX'")
    write_text(f"{workdir}/sql", "revenue_by_category.sql", "SELECT SUM(price) FROM events")
    main(["sql", "--lake", lake, "--folder", f"{workdir}/sql", "--csv", f"{workdir}/out"], spark=spark)
    out = capsys.readouterr().out
    assert "== days" in out and "revenue_by_category" not in out
    assert spark.read.option("header", True).csv(f"{workdir}/out/days").count() == 60
    assert not os.path.exists(f"{workdir}/out/none")             # no file for an empty result


def test_cli_tables(spark, workdir, capsys):
    lake, store = f"{workdir}/lake", f"{workdir}/store"
    run_etl(spark, write_text(workdir, "in.csv", DIRTY), lake)
    main(["job", "--lake", lake, "--store", store], spark=spark)
    out = capsys.readouterr().out
    assert "session_depth" in out and "hourly_traffic" not in out
    main(["tables", "--store", store], spark=spark)
    assert "mr_session_depth" in capsys.readouterr().out
