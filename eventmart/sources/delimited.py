"""Delimited event files: header and separator of every file, scan, declared types, malformed rows.

* Every file's own header line decides its separator and columns, so files of one input may differ in
  both.  Headers are found by a Spark job, a task a file that stops after its first line; the driver gets the distinct header lines, and
  files by name only where they differ.  Files with the same layout are scanned together, and layouts are united by canonical name.
* Lines are read as text and parsed by Spark's CSV parser beside it, with every field as text and positional names; missing-value tokens
  become null; then every column gets the type declared for its canonical name (``COLUMN_TYPES``; any
  other column is text).  Types never depend on the data, so two inputs of one lake always fit.
* A row with more or fewer fields than its header, or with an odd number of quote signs in its line (a quote cuts it),
  is malformed: it is kept apart with its text, never cut or padded in silence.  A quoted value may end in a quote sign, or be nothing else.
* Lines that repeat the header are headers.
* ``files_with_breaks`` finds the files in which a quoted field goes on in the next line; those alone are read as a whole (a task a file),
  all others stay splittable.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart.functions.expressions import to_double
from eventmart.functions.naming import column_plan, count_separator, dedupe_header
from eventmart.session import run_dir

# Field texts read as missing (pandas' default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Declared types: identifiers are text without outer spaces; other columns not named here are text as it is.
COLUMN_TYPES = {
    **dict.fromkeys(("session_id", "user_id", "product_id"), "id"),
    **dict.fromkeys(("year", "month", "day", "event_sequence", "page_number"), "bigint"),
    **dict.fromkeys(("price", "price_secondary", "category_id"), "double"),
}

#: Column with the text of a malformed row; null in all others.
BAD_ROW = "_bad_row"
_BOM = "\ufeff"
#: Above any file's size: files are neither cut nor read together.
_WHOLE = str(1 << 50)
#: Lists of file names of one header line, at most so many a line.
_NAME_LISTS = 64


@dataclass(frozen=True)
class Layout:
    """Files that share separator and header: ``files`` (or the folders that hold nothing else), the ``lines`` that are
    their headers, and those of them that are read as a whole."""
    sep: str
    header: tuple[str, ...]
    files: tuple[str, ...]
    lines: tuple[str, ...]
    whole: tuple[str, ...] = ()


def _text(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(list(paths))


def _path(file: str) -> str:
    """A file's name as Spark tells it, as a path that means this file only."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(file))


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line with text of a task's only file; the rest of it is not read."""
    for batch in batches:
        for i, line in enumerate(batch.column("line").to_pylist()):
            if line.strip(f" \t{_BOM}"):
                yield batch.slice(i, 1)
                return


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line, files): the distinct header lines, with lists of their files."""
    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, _WHOLE)
    lines = _text(own, paths).select(F.ltrim("value", F.lit(_BOM)).alias("line"), F.col("_metadata.file_path").alias("file"))
    found = lines.mapInArrow(_first_line, "line string, file string")
    listed = found.groupBy("line", F.pmod(F.hash("file"), F.lit(_NAME_LISTS)).alias("part")).agg(F.collect_list("file").alias("files")).drop("part")
    folder = run_dir(spark, "headers")
    listed.write.parquet(folder)
    return spark.read.schema(listed.schema).parquet(folder)


def parse_header(line: str, sep: str) -> tuple[str, ...]:
    if line.count('"') % 2:
        raise ValueError(f"line break inside a header: {line!r}")
    return tuple(dedupe_header(next(csv.reader([line], delimiter=sep))))


def layouts(spark: SparkSession, paths: list[str], sep: str | None = None) -> list[Layout]:
    """The layouts of an input; the separator is found for each file unless it is given."""
    listed = header_lines(spark, paths)
    groups: dict[tuple, list[str]] = {}
    for row in listed.select("line").distinct().orderBy("line").toLocalIterator():     # a row a header line
        own = sep or count_separator(row["line"])
        groups.setdefault((own, parse_header(row["line"], own)), []).append(row["line"])
    if not groups:
        raise ValueError(f"{paths}: empty input")
    if len(groups) == 1:
        ((s, header), lines), = groups.items()
        return [Layout(s, header, tuple(paths), tuple(lines))]
    out = []
    for (s, header), lines in groups.items():
        names = listed.filter(F.col("line").isin(lines)).select(F.explode("files").alias("file")).orderBy("file")
        out.append(Layout(s, header, tuple(_path(r["file"]) for r in names.toLocalIterator()), tuple(lines)))
    return out


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def files_with_breaks(spark: SparkSession, layout: Layout) -> Layout:
    """The layout with those files as ``whole`` in which a quoted field goes on in the next line: a line ends inside quotes, and all
    quotes of the file are closed."""
    s = re.escape(layout.sep)
    # complete fields, then one that begins with a quote and has no other that closes it
    inside = rf'^(?:(?:"(?:[^"]|"")*+"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+"(?:[^"]|"")*+$'
    by_file = _text(spark, layout.files).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_or(F.col("value").rlike(inside)).alias("open"), F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    names = by_file.filter("open and quotes % 2 = 0").select("file").orderBy("file")
    return replace(layout, whole=tuple(r["file"] for r in names.toLocalIterator()))


def _options(layout: Layout) -> dict:
    # all fields are counted in every row, whichever are used
    return {"sep": layout.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "columnPruning": "false"}


def scan_text(spark: SparkSession, layout: Layout, multi_line: bool = False) -> DataFrame:
    """Fields as text under their canonical names (first of an alias group wins), and ``BAD_ROW``."""
    names = [f"_c{i}" for i in range(len(layout.header))]
    schema = StructType([StructField(c, StringType()) for c in [*names, "_corrupt"]])
    fields = [F.when(~F.col(names[i]).isin(NA_TOKENS), F.col(names[i])).alias(c) for i, c in column_plan(list(layout.header))]
    parts = []
    if not multi_line:
        lines = _text(spark, layout.files)
        if layout.whole:
            lines = lines.filter(~F.col("_metadata.file_path").isin(list(layout.whole)))
        lines = lines.filter((F.trim("value") != "") & ~F.ltrim("value", F.lit(_BOM)).isin(list(layout.lines)))
        parsed = lines.select("value", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), _options(layout)).alias("row")).select("value", "row.*")
        parts.append(parsed.select(*fields, F.when(F.col("_corrupt").isNotNull() | _odd_quotes(F.col("value")), F.col("value")).alias(BAD_ROW)))
    if multi_line or layout.whole:
        files = list(layout.files) if multi_line else [_path(f) for f in layout.whole]
        raw = spark.read.schema(schema).options(**_options(layout)).option("recursiveFileLookup", True).option("header", True).option("encoding", "UTF-8").option("multiLine", True).csv(files)
        # Spark reads no raw file for the corrupt column alone: nothing of a field stands beside it
        beside = F.substr(F.coalesce(F.col(names[0]), F.lit("")), F.lit(1), F.lit(0))
        parts.append(raw.select(*fields, F.concat("_corrupt", beside).alias(BAD_ROW)))
    return reduce(DataFrame.unionAll, parts)


def apply_types(df: DataFrame) -> DataFrame:
    """Text columns -> the declared types; a value that does not fit is null."""
    def typed(c: str) -> Column:
        kind = COLUMN_TYPES.get(c)
        if kind == "id":
            text = F.trim(c)
            return F.when(text != "", text)
        if kind == "bigint":
            number = to_double(c)
            return F.coalesce(F.trim(c).try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
        return to_double(c) if kind == "double" else F.col(c)
    return df.select(*[typed(c).alias(c) for c in df.columns])


def read_layouts(spark: SparkSession, found: list[Layout], multi_line: bool = False) -> DataFrame:
    """All layouts as one frame of typed canonical columns and ``BAD_ROW``; a column that a layout lacks is null."""
    frames = [apply_types(scan_text(spark, x, multi_line)) for x in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
