"""Marts kept up to date by the states of the lake's inputs."""

import pytest
from pyspark.sql import functions as F

from eventmart.operators import mart_states
from eventmart.operators.mart_states import update_marts
from eventmart.operators.marts import MART_NAMES, build_marts
from eventmart.sources.lake import TableStore, read_lake, write_lake


def events(spark, first, last, price=True, country=True):
    df = spark.range(first, last).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") % 40).cast("string")).alias("session_id"),
        F.format_string("2024-01-%02d", (F.col("id") % 9 + 1).cast("int")).alias("event_date_str"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("P"), (F.col("id") % 70).cast("string"))).alias("product_id"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("category_name"),
        F.when(F.col("id") % 5 > 0, F.lit("DE")).alias("country"), (F.col("id") % 13 / 4).alias("price"))
    return df.drop(*([] if price else ["price"]), *([] if country else ["country"]))


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def same_as_rebuilt(spark, store, lake, workdir):
    built = build_marts(TableStore(spark, f"{workdir}/whole"), read_lake(spark, lake))
    assert set(built) == set(store.names())
    for name, whole in built.items():
        assert store.read(name).dtypes == whole.dtypes and rows(store.read(name)) == rows(whole), name


def test_only_changed_inputs_are_read(spark, workdir):
    lake, store = f"{workdir}/lake", TableStore(spark, f"{workdir}/marts")
    write_lake(events(spark, 0, 900, price=False, country=False), lake, "plain")
    marts, read = update_marts(store, lake)
    assert read == ["plain"] and set(marts) == set(MART_NAMES) - {"country_metrics"} and "total_revenue" not in marts["daily_metrics"].columns
    write_lake(events(spark, 500, 1500), lake, "more")
    assert update_marts(store, lake)[1] == ["more"]
    same_as_rebuilt(spark, store, lake, f"{workdir}/2")
    write_lake(events(spark, 0, 300), lake, "plain")                          # fewer rows, and now with all columns
    assert update_marts(store, lake)[1] == ["plain"]
    same_as_rebuilt(spark, store, lake, f"{workdir}/3")
    assert update_marts(store, lake)[1] == []
    same_as_rebuilt(spark, store, lake, f"{workdir}/4")


def test_input_without_rows(spark, workdir):
    lake, store = f"{workdir}/lake", TableStore(spark, f"{workdir}/marts")
    write_lake(events(spark, 0, 200), lake, "a")
    write_lake(events(spark, 0, 50), lake, "b")
    update_marts(store, lake)
    write_lake(events(spark, 0, 0), lake, "b")
    assert update_marts(store, lake)[1] == ["b"]
    same_as_rebuilt(spark, store, lake, workdir)


def test_failed_update_leaves_the_marts(spark, workdir, monkeypatch):
    lake, store = f"{workdir}/lake", TableStore(spark, f"{workdir}/marts")
    write_lake(events(spark, 0, 200), lake, "a")
    update_marts(store, lake)
    before = {n: rows(store.read(n)) for n in store.names()}
    write_lake(events(spark, 0, 900), lake, "a")
    whole = mart_states.session_states
    broken = lambda df: whole(df).withColumn("events", F.expr("if(key is null, raise_error('lost'), events)"))
    monkeypatch.setattr(mart_states, "session_states", broken)
    with pytest.raises(Exception, match="lost"):
        update_marts(store, lake)
    assert {n: rows(store.read(n)) for n in store.names()} == before
    monkeypatch.setattr(mart_states, "session_states", whole)
    assert update_marts(store, lake)[1] == ["a"]
    same_as_rebuilt(spark, store, lake, workdir)
