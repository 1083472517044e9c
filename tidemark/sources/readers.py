"""Readers: thin, schema-first wrappers over ``spark.read``."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued_data"


class Tables:
    """Attribute access to the Parquet tables of one folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_glob(spark: SparkSession, pattern: str, base_path: str | None = None) -> DataFrame:
    """All Parquet files matching ``pattern`` as one table.

    ``base_path`` keeps partition columns that sit in the matched folder names.
    """
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(pattern)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    delimiter: str = ",",
    header: bool = True,
    infer: bool = True,
) -> DataFrame:
    """A delimited text table.

    With ``schema`` the files are read once. Without it types are inferred (one extra pass)
    or, with ``infer=False``, every column stays a string.
    """
    reader = spark.read.option("header", header).option("delimiter", delimiter)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Newline-delimited JSON under a declared schema."""
    return spark.read.schema(schema).json(path)


def read_binary(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Files as rows ``(path, modificationTime, length, content)``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def rescued_schema(schema: StructType | str) -> StructType:
    """``schema`` plus the side column that receives the text of lines that do not fit."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return StructType([*fields.fields, StructField(RESCUED, StringType(), True)])


def read_rescued(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = True
) -> DataFrame:
    """CSV that never fails on drift: a line with extra or malformed fields keeps what parsed,
    and its whole text lands in ``_rescued_data``.

    With ``header`` columns are found by the names in each file's own first line, in any order. A column that a file
    lacks is NULL; columns that ``schema`` lacks land in ``_rescued_data`` as JSON of their names and values, with the
    whole line as ``_line`` if it is malformed besides. Files are read once.
    """
    return rescued_lines(spark.read.text(path), schema, header)


def rescued_lines(lines: DataFrame, schema: StructType | str, header: bool = True) -> DataFrame:
    """The rows of CSV files given as lines of Spark's text source, read at once or as a stream (see ``read_rescued``).

    Lines of files that have the declared header stay as they are. Those of others are put into the declared order in
    Arrow batches, so that all are parsed by the same expression. A task that begins in the middle of a large file
    reads the file's first line by itself.
    """
    full = rescued_schema(schema)
    names = full.names[:-1]
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = lines.where(F.trim("value") != "")
    if header:
        exact = lines.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        lines = lines.mapInArrow(_aligned(names, exact), "value string, line string, other string")
    else:
        lines = lines.select("value", F.col("value").alias("line"), F.lit(None).cast("string").alias("other"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parsed = lines.withColumn("_row", F.from_csv("line", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}))
    whole = F.when(F.col(f"_row.{RESCUED}").isNotNull(), F.col("value"))
    both = F.concat(F.expr("left(other, length(other) - 1)"), F.lit(","), F.expr("substr(to_json(struct(value AS _line)), 2)"))
    rescued = F.when(F.col("other").isNull(), whole).otherwise(F.when(whole.isNull(), F.col("other")).otherwise(both))
    return parsed.select(*[F.col(f"_row.{n}").alias(n) for n in names], rescued.alias(RESCUED))


# A field of a CSV line as Spark reads it: in quotes, where a quote is doubled or behind a backslash, or up to the comma.
_FIELD = re.compile(r'(?:"((?:[^"\\]|\\.|"")*+)"|([^,]*))(?:,|$)', re.DOTALL)
_ESCAPED = re.compile(r'\\(["\\])|""')


def _fields(line: str) -> list[str | None]:
    """The fields of a CSV line; an empty one without quotes is None."""
    out, at = [], 0
    while True:
        found = _FIELD.match(line, at)
        quoted, plain = found.groups()
        out.append((plain or None) if quoted is None else _ESCAPED.sub(lambda m: m[1] or '"', quoted))
        more = line.endswith(",", at, found.end())
        at = found.end()
        if at == len(line):
            return [*out, None] if more else out


def _field(value: str | None) -> str:
    """A field so that Spark's parser gives the same value back."""
    if value is None:
        return ""
    return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'


def _first_line(file: str) -> str:
    """The first line of a file that is not blank."""
    fs, path = FileSystem.from_uri(file.replace("file:/", "file:///", 1) if re.match("file:/(?!/)", file) else file)
    with fs.open_input_stream(path) as source:
        for line in io.TextIOWrapper(source, "utf-8", errors="replace"):
            if line.strip():
                return line.rstrip("\r\n")
    return ""


class _Header:
    """How the lines of one file become lines in the declared order."""

    def __init__(self, line: str, names: Sequence[str], fold: Callable[[str], str]):
        own = [n or "" for n in _fields(line.removeprefix("\ufeff"))]
        self.same = [fold(n) for n in own] == [fold(n) for n in names]
        places: dict[str, int] = {}
        for i, name in enumerate(own):
            places.setdefault(fold(name), i)
        wanted = {fold(n) for n in names}
        self.at = [places.get(fold(n)) for n in names]
        self.others = [(n if places[fold(n)] == i else f"{n}_{i}", i) for i, n in enumerate(own) if fold(n) not in wanted or places[fold(n)] != i]
        self.width = len(own)

    def aligned(self, line: str) -> tuple[str, str | None]:
        """The line in the declared order, and its other columns as JSON. One with too many or too few fields stays
        malformed: it gets one field too many."""
        fields = _fields(line)
        found = fields + [None] * (self.width - len(fields))
        out = ",".join(_field(None if i is None else found[i]) for i in self.at)
        others = {n: found[i] for n, i in self.others if found[i] is not None}
        told = json.dumps(others, ensure_ascii=False, separators=(",", ":")) if others else None
        return out + ("" if len(fields) == self.width else ",?"), told


def _aligned(names: list[str], exact: bool):
    fold = str if exact else str.lower

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, header = None, None
        for batch in batches:
            values, lines, others = [], [], []
            for value, file, start in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "start"))):
                if (file, start) != part:
                    part = (file, start)
                    header = _Header(value if start == 0 else _first_line(file), names, fold)
                    if start == 0:
                        continue
                line, other = (value, None) if header.same else header.aligned(value)
                values.append(value)
                lines.append(line)
                others.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (values, lines, others)], names=["value", "line", "other"])

    return run


def file_sizes(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> DataFrame:
    """``(path, length)`` of the data files under ``path``; no file content is read."""
    return read_binary(spark, path, glob).select(F.col("path"), F.col("length"))
