"""User-defined map/reduce over DataFrames.

A job is ``map``: rows -> 0..n ``(key, value...)`` pairs, then ``reduce``: all
values of one key -> one result.  Spark does the shuffle.

* The mapper runs on Arrow batches (``mapInPandas``): ``mapper(pdf) -> pdf``
  with a ``key`` column and the value columns of ``pair_schema``.  ``per_row``
  adapts a row function ``fn(row) -> [(key, value), ...]`` (``row.get(name)``
  works) for callers that have one; it is the slow path.
* The reducer is either
  - a dict ``{result_name: Column aggregate}`` over the value columns – the
    default: Spark aggregates partially in every map task, shuffles only
    partial states and finishes per key, so a key holding a third of all rows
    costs no more than any other; or
  - ``Combine(combine, finish)`` for a Python reduce.  ``combine`` must be
    associative and commutative (the order of partial results is the shuffle's); its output has the value columns
    again.  Every Arrow batch of pairs is combined where it is made; partial results of ``FAN_IN`` neighbouring
    map tasks meet first, then those of the whole key, both in grouped iterators, so that no task holds a
    key's values at once, and a hot key is spread over as many tasks as there are map tasks to ``FAN_IN``.
  A reduce that is not associative (exact distinct counts, medians) belongs in
  the Column form (``F.count_distinct``, ``F.percentile``), which Spark plans
  with its own two-level shuffle.

``phase_outputs`` gives the map/shuffle/reduce views of a job as DataFrames
(all pairs, values per key, JSON-encoded results) and ``save_phase_outputs``
writes them as CSV.  A job with an ``output_dir`` maps once: its pairs are written, and everything else reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from eventmart.operators.sinks import write_csv

#: Map tasks whose partial results of a key meet in one task.
FAN_IN = 32


def per_row(fn: Callable[[dict], Iterable[tuple]], value_names: list[str] | None = None):
    """Adapt ``fn(row) -> iterable of (key, value)`` to a batch mapper: the slow path, one Python call a row.

    ``row`` is a dict (so ``row.get(name, default)`` works).  With
    ``value_names``, tuple values are spread over those value columns.
    """
    def mapper(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = [pair for row in pdf.to_dict("records") for pair in fn(row) or ()]
        keys = [k for k, _ in pairs]
        if value_names:
            return pd.DataFrame([v for _, v in pairs], columns=value_names).assign(key=keys)[["key", *value_names]]
        return pd.DataFrame({"key": keys, "value": [v for _, v in pairs]})
    return mapper


@dataclass
class Combine:
    """Associative and commutative Python reduce (see module doc)."""

    combine: Callable[[object, pd.DataFrame], dict]
    finish: Callable[[object, dict], dict] | None = None
    result_schema: str | None = None  # DDL of finish's output (without key)


def _value_names(pair_schema: StructType) -> list[str]:
    return [f.name for f in pair_schema.fields if f.name != "key"]


def emit_pairs(df: DataFrame, mapper, pair_schema: str | StructType,
               columns: list[str] | None = None) -> DataFrame:
    """Map phase: ``mapper`` over Arrow batches -> pair rows.

    ``columns`` names what the mapper reads; only those reach Python (and the
    scan below is pruned to them)."""
    src = df.select(*columns) if columns else df

    def run(batches):
        for pdf in batches:
            out = mapper(pdf)
            if out is not None and len(out):
                yield out

    return src.mapInPandas(run, pair_schema)


def _combined(pairs: DataFrame, schema: StructType, red: Combine) -> DataFrame:
    """Pairs -> one row a key."""
    names = _value_names(schema)
    columns = [f.name for f in schema.fields]
    combine, finish = red.combine, red.finish
    partial = StructType([*schema.fields]).add("part", IntegerType())

    def by_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() // FAN_IN
        for pdf in batches:
            rows = [{"key": None if pd.isna(key) else key, **combine(None if pd.isna(key) else key, own[names].reset_index(drop=True))}
                    for key, own in pdf.groupby("key", sort=False, dropna=False)]
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype({"key": object}).assign(part=part)

    def folded(key, batches: Iterator[pd.DataFrame]) -> dict:
        total = None
        for pdf in batches:
            values = pdf[names].reset_index(drop=True)
            total = combine(key, values if total is None else pd.concat([pd.DataFrame([total], columns=names), values], ignore_index=True))
        return total

    def by_part(group: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = None if pd.isna(group[0]) else group[0]
        yield pd.DataFrame([{"key": key, **folded(key, batches), "part": group[1]}], columns=[*columns, "part"]).astype({"key": object})

    out_schema = schema if finish is None else StructType([schema["key"], *StructType.fromDDL(red.result_schema).fields])

    def by_key(group: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = None if pd.isna(group[0]) else group[0]
        total = folded(key, batches)
        yield pd.DataFrame([{"key": key, **(finish(key, total) if finish else total)}], columns=[f.name for f in out_schema.fields]).astype({"key": object})

    return (pairs.mapInPandas(by_batch, partial)
            .groupBy("key", "part").applyInPandas(by_part, partial)
            .groupBy("key").applyInPandas(by_key, out_schema))


def map_reduce(df: DataFrame, mapper, reducer, pair_schema: str | StructType, *,
               columns: list[str] | None = None, job_name: str = "job",
               output_dir: str | None = None) -> DataFrame:
    """Run one map/reduce job; returns ``(key, result...)`` rows (lazy)."""
    schema = pair_schema if isinstance(pair_schema, StructType) else StructType.fromDDL(pair_schema)
    pairs = emit_pairs(df, mapper, schema, columns)
    if output_dir:
        path = f"{output_dir.rstrip('/')}/{_safe(job_name)}_pairs"
        pairs.write.mode("overwrite").parquet(path)
        pairs = df.sparkSession.read.schema(schema).parquet(path)
    result = _combined(pairs, schema, reducer) if isinstance(reducer, Combine) else reduce_pairs(pairs, reducer)
    if output_dir:
        save_phase_outputs(phase_outputs(pairs, result), output_dir, job_name)
    return result


def reduce_pairs(pairs: DataFrame, aggregates: dict[str, Column | Callable]) -> DataFrame:
    """Reduce phase with built-in aggregates: ``{name: Column}`` or
    ``{name: f(value_column) -> Column}`` (for a single ``value`` column)."""
    aggs = []
    for name, agg in aggregates.items():
        col = agg(F.col("value")) if callable(agg) and not isinstance(agg, Column) else agg
        aggs.append(col.alias(name))
    return pairs.groupBy("key").agg(*aggs)


def phase_outputs(pairs: DataFrame, reduced: DataFrame) -> dict[str, DataFrame]:
    """The three inspectable phase views of a job."""
    return {"map": map_view(pairs), "shuffle": key_sizes(pairs), "reduce": reduced_json(reduced)}


def map_view(pairs: DataFrame) -> DataFrame:
    """Every pair, structured values as JSON text."""
    return pairs.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, StructType) else F.col(f.name)
                          for f in pairs.schema.fields])


def key_sizes(pairs: DataFrame) -> DataFrame:
    """Values per key after the shuffle – the job's key-skew profile."""
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("value_count"))


def reduced_json(reduced: DataFrame, result_cols: list[str] | None = None) -> DataFrame:
    """Reduce output with a multi-field result encoded as one JSON text."""
    result_cols = result_cols or [c for c in reduced.columns if c != "key"]
    if len(result_cols) == 1:
        return reduced.select("key", F.col(result_cols[0]).alias("reduced_value"))
    return reduced.select("key", F.to_json(F.struct(*result_cols)).alias("reduced_value"))


def _safe(job_name: str) -> str:
    return job_name.replace("/", "_")


def save_phase_outputs(outputs: dict[str, DataFrame], output_dir: str, job_name: str) -> None:
    for phase, frame in outputs.items():
        write_csv(frame, f"{output_dir.rstrip('/')}/{_safe(job_name)}_{phase}_output")


def results_to_frame(reduced: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """Two-column result sorted by value, largest first (ties by key)."""
    value = [c for c in reduced.columns if c != "key"][0]
    return (reduced.select(F.col("key").alias(key_col), F.col(value).alias(value_col))
            .orderBy(F.desc(value_col), F.asc_nulls_last(key_col)))
