"""ETL edge rows (dirty files written by the tests themselves)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from eventmart.operators import etl
from eventmart.operators.etl import SchemaError, drop_duplicate_rows, read_events_file, run_etl, well_formed
from eventmart.sources import delimited
from eventmart.sources.lake import read_lake
from eventmart.sources.snapshots import Snapshots
from tests.conftest import write_text

DIRTY = """Year;Month; DAY ;Session ID;Page 1 (main category);Page 2 (clothing model);Country;Price;Revenue;Page;Extra Col!
2008;4;1;1;1;A1;PL;28;99;1;x
2008;4;1;1;1;A1;PL;28;99;1;x
2008;4;1;1;1;A1; PL ;28;99;1;x
2008;4;1; 1;1;A1;PL;28;99;1;x
2008;2;30;2;9;B2;;abc;5;2;y
2008;5;2;3;x;C3;NA;;7;3;z
2008;5;2;4;4;D4;DE;12.5;1;5;
"""

EXPECTED = sorted([
    ("1", "PL", 28.0, "2008-04-01", 0, "2008-04", "Tuesday", "Trousers"),
    ("1", "PL", 28.0, "2008-04-01", 0, "2008-04", "Tuesday", "Trousers"),
    ("2", "unknown", 0.0, None, None, None, None, "Other"),
    ("3", "unknown", 0.0, "2008-05-02", 0, "2008-05", "Friday", "Other"),
    ("4", "DE", 12.5, "2008-05-02", 0, "2008-05", "Friday", "Sale"),
], key=str)

COLS = ["session_id", "country", "price", "event_date_str", "event_hour", "event_month",
        "day_of_week", "category_name"]


def _rows(df):
    return sorted([tuple(r) for r in df.select(*COLS).collect()], key=str)


def test_dirty_file_end_to_end(spark, workdir):
    src = write_text(workdir, "dirty.csv", DIRTY)
    res = run_etl(spark, src, f"{workdir}/lake")
    assert res.separator == ";"
    assert res.metrics["rows_read"] == 7
    assert res.metrics["rows_written"] == 5
    assert res.metrics["duplicates_dropped"] == 2
    lake = read_lake(spark, f"{workdir}/lake")
    assert _rows(lake) == EXPECTED
    assert "extra_col" in lake.columns and "revenue" not in lake.columns
    assert dict(lake.dtypes)["event_date_str"] == "string"
    days = {r[0] for r in lake.select("event_date_str").distinct().collect()}
    assert days == {"2008-04-01", "2008-05-02", None}
    # re-running replaces the rows of this input: still 5 rows (read the lake anew:
    # a frame read before the rerun lists files the rerun replaced)
    run_etl(spark, src, f"{workdir}/lake")
    assert _rows(read_lake(spark, f"{workdir}/lake")) == EXPECTED


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_separator_variants_give_same_rows(spark, workdir, sep):
    src = write_text(workdir, "dirty.txt", DIRTY.replace(";", sep))
    res = run_etl(spark, src, f"{workdir}/lake")
    assert res.separator == sep
    assert _rows(read_lake(spark, f"{workdir}/lake")) == EXPECTED


# (session ids, rows kept) -- each file also has a constant column p = 1; ids are text without outer spaces
DEDUP_CASES = [
    (["9007199254740993", "9007199254740992", "9007199254740993"], 2),
    (["9007199254740993", "9007199254740992", "NA"], 3),
    (["5", "5d", "5.0"], 3),
    (["7", "007", "A1"], 3),
    ([" 1", "1", "1 "], 1),
    (["A", "A ", " A"], 1),
    (["1.0", "1", "1e0"], 3),
    (["NA", "", "2"], 2),
]


@pytest.mark.parametrize("values,kept", DEDUP_CASES)
def test_dedup_on_declared_types(spark, workdir, values, kept):
    body = "session_id,p\n" + "".join(f"{v},1\n" for v in values)
    typed, *_ = read_events_file(spark, write_text(workdir, "d.csv", body))
    assert drop_duplicate_rows(well_formed(typed)).count() == kept


def test_two_inputs_and_a_rerun(spark, workdir):
    """Another input adds rows to the same days, undated rows included; a rerun replaces only its own."""
    one = write_text(workdir, "one.csv", "timestamp,session_id\n2024-01-01 10:00:00,a\nnever,b\n")
    two = write_text(workdir, "two.csv", "timestamp,session_id\n2024-01-01 11:00:00,c\nnever,d\n")
    lake = f"{workdir}/lake"
    for src in (one, two, one):
        run_etl(spark, src, lake)
    assert sorted(r.session_id for r in read_lake(spark, lake).collect()) == ["a", "b", "c", "d"]
    write_text(workdir, "one.csv", "timestamp,session_id\n2024-01-02 10:00:00,a2\n")
    spark.catalog.clearCache()
    run_etl(spark, one, lake)
    assert sorted(r.session_id for r in read_lake(spark, lake).collect()) == ["a2", "c", "d"]


def test_files_of_one_input_may_differ_in_layout(spark, workdir):
    folder = os.path.join(workdir, "in")
    os.makedirs(folder)
    write_text(folder, "a.csv", "session_id,price,timestamp\na,1.5,2024-01-01 10:00:00\n")
    write_text(folder, "b.csv", "timestamp;Session ID;amount;Extra\n2024-01-02;b;2,5;x\n2024-01-02;c;3.5;y\n")
    write_text(folder, "empty.csv", "")
    res = run_etl(spark, folder, f"{workdir}/lake")
    assert sorted(x.sep for x in res.layouts) == [",", ";"]
    rows = {r.session_id: (r.price, r.event_date_str, r.extra) for r in read_lake(spark, f"{workdir}/lake").collect()}
    assert rows == {"a": (1.5, "2024-01-01", None), "b": (0.0, "2024-01-02", "x"), "c": (3.5, "2024-01-02", "y")}


BROKEN = 'session_id,price,country\na,1,PL\nb,2\nc,3,DE,EXTRA\nd,4,"open\nrest"\n'


def test_malformed_rows_stop_the_run(spark, workdir):
    src = write_text(workdir, "broken.csv", BROKEN)
    with pytest.raises(PySparkException, match="malformed row"):
        run_etl(spark, src, f"{workdir}/lake")
    assert not os.path.exists(f"{workdir}/lake/_SUCCESS")


def test_malformed_rows_are_kept_apart(spark, workdir):
    src = write_text(workdir, "broken.csv", BROKEN)
    # line by line, both halves of a row that a quote cuts are malformed
    m = run_etl(spark, src, f"{workdir}/lake", quarantine=f"{workdir}/bad", multi_line=False).metrics
    assert (m["rows_read"], m["rows_malformed"], m["rows_written"], m["duplicates_dropped"]) == (5, 4, 1, 0)
    assert sorted(r.line for r in spark.read.parquet(f"{workdir}/bad").collect()) == ["b,2", "c,3,DE,EXTRA", 'd,4,"open', 'rest"']
    # the file has a field that goes on in the next line, so it is read as a whole
    m = run_etl(spark, src, f"{workdir}/lake", quarantine=f"{workdir}/bad").metrics
    assert (m["rows_read"], m["rows_malformed"], m["rows_written"], m["duplicates_dropped"]) == (4, 2, 2, 0)
    assert sorted(r.line for r in spark.read.parquet(f"{workdir}/bad").collect()) == ["b,2", "c,3,DE,EXTRA"]
    assert {r.session_id: r.country for r in read_lake(spark, f"{workdir}/lake").collect()} == {"a": "PL", "d": "open\nrest"}


def test_line_breaks_inside_quotes(spark, workdir):
    src = write_text(workdir, "q.csv", 'session_id,price,note\na,1,"two\nlines, and ""quotes"""\nb,2,plain\n')
    with pytest.raises(PySparkException, match="malformed row"):
        run_etl(spark, src, f"{workdir}/lake", multi_line=False)
    for how in (True, None):
        run_etl(spark, src, f"{workdir}/lake", multi_line=how)
        notes = {r.session_id: r.note for r in read_lake(spark, f"{workdir}/lake").collect()}
        assert notes == {"a": 'two\nlines, and "quotes"', "b": "plain"}


def test_valid_quoted_values(spark, workdir):
    """Values that end in a quote sign, or are one; a file with line breaks beside them, and one whose quote is never closed."""
    folder = os.path.join(workdir, "in put")
    os.makedirs(folder)
    write_text(folder, "a.csv", 'session_id,note,price\na,"TV 55""",1\nb,"""so said""",2\nc,"""",3\nd,say "hi",4\ne,"",5\nf,"x;y,z",6\n')
    res = run_etl(spark, folder, f"{workdir}/one")
    assert res.metrics["rows_malformed"] == 0
    want = {"a": 'TV 55"', "b": '"so said"', "c": '"', "d": 'say "hi"', "e": None, "f": "x;y,z"}
    assert {r.session_id: r.note for r in read_lake(spark, f"{workdir}/one").collect()} == want
    write_text(folder, "b [2].csv", 'session_id,note,price\ng,"two\nlines",7\nh,plain,8\n')
    write_text(folder, "c.csv", 'session_id,note,price\ni,"never closed,9\nj,fine,10\n')
    res = run_etl(spark, folder, f"{workdir}/two", quarantine=f"{workdir}/bad")
    got = {r.session_id: r.note for r in read_lake(spark, f"{workdir}/two").collect()}
    assert got == want | {"g": "two\nlines", "h": "plain", "j": "fine"}
    assert [r.line for r in spark.read.parquet(f"{workdir}/bad").collect()] == ['i,"never closed,9']
    assert [len(x.whole) for x in res.layouts] == [1]


def test_headers_of_many_files(spark, workdir):
    """The driver gets a row a header line, whatever the number of files."""
    folder = os.path.join(workdir, "many")
    os.makedirs(folder)
    for i in range(600):
        body = f"session_id,price\ns{i},{i}\n" if i % 3 else f"\ufeffprice;session_id\n{i};s{i}\n"
        write_text(folder, f"f{i:04d}.csv", body if i != 7 else f"\n  \n{body}")
    found = delimited.header_lines(spark, [folder])
    assert {r.line for r in found.select("line").distinct().collect()} == {"session_id,price", "price;session_id"}
    assert sum(len(r.files) for r in found.collect()) == 600 and found.count() <= 2 * 64
    typed, got, _ = read_events_file(spark, folder)
    assert sorted((x.sep, len(x.files)) for x in got) == [(",", 400), (";", 200)]
    assert {(r.session_id, r.price) for r in well_formed(typed).collect()} == {(f"s{i}", float(i)) for i in range(600)}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_rerun_replaces_whole_versions(spark, workdir, mode):
    """A rerun with fewer days leaves no old ones, under both overwrite modes."""
    lake, before = f"{workdir}/lake", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        src = write_text(workdir, "in.csv", "timestamp,session_id\n2024-01-01 10:00:00,a\n2024-01-02 10:00:00,b\n")
        run_etl(spark, src, lake)
        seen = read_lake(spark, lake)
        write_text(workdir, "in.csv", "timestamp,session_id\n2024-01-02 10:00:00,c\n")
        run_etl(spark, src, lake)
        assert [r.session_id for r in read_lake(spark, lake).collect()] == ["c"]
        assert sorted(r.session_id for r in seen.collect()) == ["a", "b"]          # a reader that began before
        run_etl(spark, f"file://{src}", lake)
        assert [r.session_id for r in read_lake(spark, lake).collect()] == ["c"]   # another spelling of the path
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def _shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def _many_days(workdir) -> str:
    """Rows of 40 days, each twice, and two without a day."""
    rows = [f"2024;{1 + d // 28};{1 + d % 28};s{d};A{d % 3};{d % 5}; {d}.5;PL" for d in range(40)] + ["x;1;1;none;A;1;1;NA", "2024;2;30;none;A;1;1;NA"]
    return write_text(workdir, "days.csv", "\n".join(["Year;Month;Day;Session ID;Clothing_Model;Category;Price;Country", *rows, *rows[:40]]) + "\n")


@pytest.mark.parametrize("staged", [False, True])
def test_a_run_leaves_no_shuffled_rows_on_disk(spark, workdir, monkeypatch, staged):
    import time
    if staged:
        monkeypatch.setattr(etl, "STAGED_FROM", 1)
        monkeypatch.setattr(etl, "SLICES", 4)
        monkeypatch.setattr(etl, "SLICE_BYTES", 1)
    src = _many_days(workdir)
    read_events_file(spark, src)
    before = _shuffle_files(spark)                   # of other tests, and of the header lines
    parts = []
    monkeypatch.setattr(etl, "_write_part", lambda rows, folder, plain=etl._write_part: (parts.append(_shuffle_files(spark)), plain(rows, folder))[1])
    monkeypatch.setattr(etl, "read_events_file", lambda *a, plain=etl.read_events_file: (lambda got: (parts.append(_shuffle_files(spark)), got)[1])(plain(*a)))
    run_etl(spark, src, f"{workdir}/lake")
    header = max(0, parts[0] - before)
    end = time.time() + 20
    while _shuffle_files(spark) > before + header and time.time() < end:             # blocks are removed by a message
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before + header
    assert len(parts) == (1 + etl.SLICES if staged else 2)


def test_staged_rows_are_those_of_one_go(spark, workdir, monkeypatch):
    src = _many_days(workdir)
    plain = run_etl(spark, src, f"{workdir}/plain")
    frames, staged = [], []
    monkeypatch.setattr(etl, "STAGED_FROM", 1)
    monkeypatch.setattr(etl, "SLICES", 4)
    monkeypatch.setattr(etl, "SLICE_BYTES", 1)
    monkeypatch.setattr(etl, "run_dir", lambda *a, make=etl.run_dir: (staged.append(make(*a)), staged[-1])[1])
    monkeypatch.setattr(etl, "drop_duplicate_rows", lambda df, drop=etl.drop_duplicate_rows: (frames.append(df.count()), drop(df))[1])
    sliced = run_etl(spark, src, f"{workdir}/sliced")
    assert len(frames) == etl.SLICES and sum(frames) == 82 and max(frames) < 50
    assert sliced.metrics == plain.metrics and plain.metrics["rows_written"] == 42 and plain.metrics["country_filled"] == 2
    assert len(staged) == 1 and not os.path.exists(staged[0])
    assert _rows(read_lake(spark, f"{workdir}/sliced")) == _rows(read_lake(spark, f"{workdir}/plain"))
    monkeypatch.setattr(etl, "SLICE_BYTES", 1 << 30)
    del frames[:]
    assert run_etl(spark, src, f"{workdir}/together").metrics == plain.metrics and frames == [82]
    # no row at all, and malformed rows, staged too
    empty = write_text(workdir, "empty.csv", "Year;Month;Day;Session ID\n")
    assert run_etl(spark, empty, f"{workdir}/empty").metrics["rows_written"] == 0
    with pytest.raises(etl.MalformedRows):
        run_etl(spark, write_text(workdir, "bad.csv", "timestamp,session_id\n2024-01-01,a\n2024-01-01,b,c\n"), f"{workdir}/bad")
    assert not os.path.exists(f"{workdir}/bad/_log") and not any(map(os.path.exists, staged))


def test_derived_columns_are_not_shuffled(spark, workdir, monkeypatch):
    plans = []
    monkeypatch.setattr(etl, "write_days", lambda df, folder, write=etl.write_days: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, folder))[1])
    run_etl(spark, _many_days(workdir), f"{workdir}/lake")
    above, _, below = plans[0].partition("RebalancePartitions")
    assert below and all(c in above and c not in below for c in ("event_month", "day_of_week", "event_date_str"))


def test_killed_staged_run_leaves_nothing_behind(spark, workdir, monkeypatch):
    src, lake, staged = _many_days(workdir), f"{workdir}/lake", []
    monkeypatch.setattr(etl, "STAGED_FROM", 1)
    monkeypatch.setattr(etl, "SLICES", 4)
    monkeypatch.setattr(etl, "SLICE_BYTES", 1)
    monkeypatch.setattr(etl, "run_dir", lambda *a, make=etl.run_dir: (staged.append(make(*a)), staged[-1])[1])
    stop = lambda df: df.withColumn("event_hour", F.when(F.col("session_id") == "s39", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("event_hour")))
    monkeypatch.setattr(etl, "add_partition_key", lambda df, plain=etl.add_partition_key: stop(plain(df)))
    with pytest.raises(PySparkException, match="killed"):
        run_etl(spark, src, lake, source="days")
    assert staged and not os.path.exists(staged[0])
    assert not os.path.exists(f"{lake}/source_id=days") or not os.listdir(f"{lake}/source_id=days")


def test_killed_rerun_leaves_the_old_rows(spark, workdir, monkeypatch):
    lake = f"{workdir}/lake"
    src = write_text(workdir, "in.csv", "timestamp,session_id\n2024-01-01 10:00:00,a\n2024-01-02 10:00:00,b\n")
    run_etl(spark, src, lake)
    write_text(workdir, "in.csv", "timestamp,session_id\n2024-01-03 10:00:00,c\n")
    broken = lambda df: df.withColumn("event_hour", F.when(F.col("session_id") == "c", F.raise_error(F.lit("killed")).cast("int")))
    with monkeypatch.context() as m:
        m.setattr(etl, "add_partition_key", lambda df, plain=etl.add_partition_key: broken(plain(df)))
        with pytest.raises(PySparkException, match="killed"):
            run_etl(spark, src, lake)
    assert sorted(r.session_id for r in read_lake(spark, lake).collect()) == ["a", "b"]
    with monkeypatch.context() as m:                                                # or in the commit itself
        m.setattr(Snapshots, "_put", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            run_etl(spark, src, lake)
    assert sorted(r.session_id for r in read_lake(spark, lake).collect()) == ["a", "b"]
    run_etl(spark, src, lake)
    assert [r.session_id for r in read_lake(spark, lake).collect()] == ["c"]


def test_snapshot_log(spark, workdir, monkeypatch):
    """Commits at once take different numbers, full entries stand for those before, old versions are deleted."""
    monkeypatch.setattr("eventmart.sources.snapshots.FULL_EVERY", 4)
    one, two = Snapshots(spark, workdir), Snapshots(spark, workdir)
    monkeypatch.setattr(one, "_numbers", lambda plain=one._numbers: (two.commit("b", two.begin()), monkeypatch.undo(), plain()[:-1])[2])
    one.commit("a", "a0")
    assert set(one.versions()) == {"a", "b"}
    monkeypatch.setattr("eventmart.sources.snapshots.FULL_EVERY", 4)
    for i in range(1, 10):
        os.makedirs(one.folder("a", f"a{i}"))
        one.commit("a", f"a{i}")
    assert two.versions()["a"] == "a9" and one.current("a").endswith("/a/_snapshot=a9") and one.current("x") is None
    assert sorted(os.listdir(f"{workdir}/a")) == ["_snapshot=a8", "_snapshot=a9"]


def test_line_break_in_a_header_fails(spark, workdir):
    with pytest.raises(ValueError, match="header"):
        run_etl(spark, write_text(workdir, "h.csv", 'session_id,"two\nlines"\na,b\n'), f"{workdir}/lake")


def test_types_do_not_depend_on_the_data(spark, workdir):
    for name, ids in (("one", "1"), ("two", "A2")):
        run_etl(spark, write_text(workdir, f"{name}.csv", f"session_id,order,other\n{ids},9007199254740993,5\n{ids}x,,x\n"), f"{workdir}/lake")
    lake = read_lake(spark, f"{workdir}/lake")
    assert {(r.session_id, r.event_sequence, r.other) for r in lake.collect()} == {("1", 9007199254740993, "5"), ("1x", None, "x"), ("A2", 9007199254740993, "5"), ("A2x", None, "x")}


def test_times_ignore_the_session_zone(spark, workdir):
    src = write_text(workdir, "z.csv", "timestamp,session_id\n03/09/2008 02:30:00,a\n2008-03-09 02:30:00,b\n9.3.2008 2:30,c\n2008/3/9 02:30:00,d\n")
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/New_York")
    try:
        run_etl(spark, src, f"{workdir}/lake")
        rows = read_lake(spark, f"{workdir}/lake").selectExpr("cast(event_time as string) t").collect()
    finally:
        spark.conf.set(key, before)
    assert {r.t for r in rows} == {"2008-03-09 02:30:00"}


def test_timestamp_variant(spark, workdir):
    src = write_text(workdir, "ts.csv",
                     "timestamp,user_id,session_id,action,product_id,amount,device\n"
                     "2024-01-01 10:05:00,u1,s1,view,p1,9.99,mobile\n"
                     "not a date,u2,s2,click,p2,1e3,\n")
    run_etl(spark, src, f"{workdir}/lake")
    rows = {r["session_id"]: r for r in read_lake(spark, f"{workdir}/lake").collect()}
    s1, s2 = rows["s1"], rows["s2"]
    assert (s1.event_hour, s1.event_month, s1.day_of_week, s1.event_date_str) == \
        (10, "2024-01", "Monday", "2024-01-01")
    assert s2.event_time is None and s2.event_month is None and s2.event_date_str is None
    assert s2.price == 1000.0 and s2.device == "unknown" and s1.device == "mobile"
    assert s1.event_type == "view" and s1.user_id == "u1"


def test_bare_date_column_is_parsed(spark, workdir):
    src = write_text(workdir, "d.csv", "date,session_id\n2024-02-03,a\nnope,b\n")
    run_etl(spark, src, f"{workdir}/lake")
    got = {r.session_id: (r.event_date_str, r.event_hour)
           for r in read_lake(spark, f"{workdir}/lake").collect()}
    assert got == {"a": ("2024-02-03", 0), "b": (None, None)}


def test_repeated_literal_header(spark, workdir):
    typed, (layout,), _ = read_events_file(
        spark, write_text(workdir, "r.csv", "price;price;session_id\n1;2;a\n"))
    assert layout.header == ("price", "price.1", "session_id")
    assert well_formed(typed).columns == ["price", "price_1", "session_id"]
    assert typed.first().price == 1


def test_missing_session_id_fails(spark, workdir):
    with pytest.raises(SchemaError):
        read_events_file(spark, write_text(workdir, "n.csv", "country,price\nPL,1\n"))


def test_no_date_columns_gives_null_times(spark, workdir):
    src = write_text(workdir, "n.csv", "session_id,category\na,2\nb,2.0\nc,2.5\n")
    run_etl(spark, src, f"{workdir}/lake")
    rows = read_lake(spark, f"{workdir}/lake").collect()
    assert all(r.event_time is None and r.event_hour is None for r in rows)
    labels = {r.session_id: r.category_name for r in rows}
    assert labels == {"a": "Skirts", "b": "Skirts", "c": "Other"}


def test_etl_metrics_frame(spark, workdir):
    from eventmart.operators.etl import etl_metrics_frame
    res = run_etl(spark, write_text(workdir, "dirty.csv", DIRTY), f"{workdir}/lake")
    row = etl_metrics_frame(spark, res).first()
    assert (row.rows_read, row.duplicates_dropped, row.rows_written, row.partitions) == (7, 2, 5, 2)
    assert str(row.min_date) == "2008-04-01" and str(row.max_date) == "2008-05-02"
    assert row.price_filled == res.metrics["price_filled"] == 2
    assert row.country_filled == 2 and row.rows_without_date == 1


def test_dates_of_parts_and_weekdays_are_as_their_texts(spark):
    """Dates built from numbers are those that their text reads as, and names of days those that Spark formats, with odd numbers too."""
    from eventmart.operators.etl import WEEKDAYS, _date_of, add_derived_columns
    years, months, days = (-1, 0, 1, 4, 1582, 1900, 2000, 2001, 9999, 10000, 2 ** 40, None), (-1, 0, 1, 2, 4, 10, 12, 13, 2 ** 40, None), (-1, 0, 1, 10, 28, 29, 30, 31, 32, 2 ** 40, None)
    parts = spark.createDataFrame([(y, m, d) for y in years for m in months for d in days], "y bigint, m bigint, d bigint")
    both = parts.select("*", _date_of(*map(F.col, "ymd")).cast("string").alias("got"), F.format_string("%04d-%02d-%02d", "y", "m", "d").try_cast("date").cast("string").alias("text"))
    assert both.filter(~F.col("got").eqNullSafe(F.col("text"))).collect() == []
    assert both.filter("got IS NOT NULL").count() > 100
    week = spark.range(-1, 8).select(F.when(F.col("id") >= 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).cast("timestamp_ntz").alias("event_time"))
    named = add_derived_columns(week).select("day_of_week", F.date_format("event_time", "EEEE")).collect()
    assert all(a == b for a, b in named) and {a for a, _ in named} == {None, *WEEKDAYS}
