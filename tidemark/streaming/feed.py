"""A stream over a versioned table's changes, whose offsets are the table's versions."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.operators.merge import CHANGE_TYPE, INSERT
from tidemark.operators.versions import COMMIT_TIME, VERSION, VersionedTable

FORMAT = "tidemark_changes"


@dataclass
class ChangeFile(InputPartition):
    """One stored file of one version; ``inserts`` if its rows carry no change type of their own."""

    path: str
    version: int
    committed: str
    inserts: bool


def _opened(path: str) -> tuple[FileSystem, str]:
    if "://" in path:
        return FileSystem.from_uri(path)
    return LocalFileSystem(), path.removeprefix("file:")


def _files(fs: FileSystem, folder: str) -> list[str]:
    """Data files of a folder, in order; none if it is not there."""
    found = fs.get_file_info(FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.type == FileType.File and f.base_name[0] not in "._")


class ChangeStream(DataSourceStreamReader):
    """Offsets are ``{"version": n}``: everything up to version n is committed and has been read.

    A version counts once its history row is there, which a writer adds last: files of a version that is being
    written, or whose writer has failed, are never seen. History files are read once each and remembered, as a
    committed row does not change.
    """

    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"].rstrip("/"), schema
        self.first = int(options.get("startingversion", 0))
        self.commits: dict[int, dict] = {}
        self.known: set[str] = set()

    def _refresh(self) -> tuple[FileSystem, str]:
        fs, root = _opened(self.path)
        for name in _files(fs, f"{root}/history"):
            if name not in self.known:
                for line in fs.open_input_stream(name).read().decode().splitlines():
                    row = json.loads(line)
                    self.commits[row["version"]] = row
                self.known.add(name)
        return fs, root

    def initialOffset(self) -> dict:
        return {"version": self.first - 1}

    def latestOffset(self) -> dict:
        self._refresh()
        return {"version": max(self.commits, default=self.first - 1)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        fs, root = self._refresh()
        out: list[InputPartition] = []
        for version in range(start["version"] + 1, end["version"] + 1):
            row = self.commits[version]
            kinds = []
            if row["operation"] == "WRITE":
                kinds.append(("snapshots", True))
            if row["operation"] not in ("WRITE", "OPTIMIZE") or row.get("deleted"):
                kinds.append(("changes", False))
            for kind, inserts in kinds:
                for name in _files(fs, f"{root}/{kind}/{VERSION}={version}"):
                    out.append(ChangeFile(name, version, row["timestamp"], inserts))
        return out

    def read(self, partition: ChangeFile) -> Iterator[pa.RecordBatch]:
        """The file's rows batch by batch, under the present schema; columns that it lacks are NULL."""
        fs, _ = _opened(self.path)
        target = to_arrow_schema(self.schema)
        stamp = pa.scalar(partition.committed).cast(pa.timestamp("us", tz="UTC"))
        fixed = {VERSION: pa.scalar(partition.version, pa.int32()), COMMIT_TIME: stamp}
        if partition.inserts:
            fixed[CHANGE_TYPE] = pa.scalar(INSERT)
        with fs.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches():
                columns = []
                for field in target:
                    if field.name in fixed:
                        column = pa.repeat(fixed[field.name], batch.num_rows)
                    elif field.name in batch.schema.names:
                        column = batch.column(field.name)
                    else:
                        column = pa.nulls(batch.num_rows, field.type)
                    columns.append(column.cast(field.type, safe=False))
                yield pa.RecordBatch.from_arrays(columns, names=target.names)


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return self.options["columns"]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeStream(dict(self.options), schema)


def stream_changes(table: VersionedTable, starting_version: int = 0) -> DataFrame:
    """Row changes of a versioned table as a stream: its columns, ``_change_type``, ``_version`` and
    ``_commit_timestamp``, as ``change_feed`` gives them.

    Nothing is copied: tasks read the table's own files, one each. A checkpoint holds the last version read, so a restart
    goes on with the next one; a micro-batch takes all versions that are committed when it is planned. The table's
    folder must be one that every executor reaches, on a filesystem that Arrow knows (local or shared paths, HDFS, S3,
    GCS). The columns are those of the table when the stream starts; compactions give no rows.
    """
    spark = table.spark
    spark.dataSource.register(ChangeSource)
    columns = table.schema().fields
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    ddl += f", `{CHANGE_TYPE}` string, `{VERSION}` int, `{COMMIT_TIME}` timestamp"
    reader = spark.readStream.format(FORMAT).option("path", table.path).option("columns", ddl)
    return reader.option("startingVersion", str(starting_version)).load()
