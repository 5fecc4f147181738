"""Feather files as a Spark data source."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

SUFFIX = ".feather"
# Record batches of a file that one task reads.
BATCHES_PER_TASK = 64
WRITE_ROWS = 65_536


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri("file://" + path)


def _files(path: str) -> tuple[fs.FileSystem, list[str]]:
    system, root = _open(path)
    if system.get_file_info(root).type == fs.FileType.File:
        return system, [root]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    # Below the root, names that start with an underscore are work that is not committed.
    return system, sorted(f.path for f in found if f.path.endswith(SUFFIX) and "/_" not in f.path[len(root.rstrip("/")):])


@dataclass
class BatchRange(InputPartition):
    file: str
    first: int
    last: int


class FeatherReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[BatchRange]:
        """Ranges of record batches; only file footers are read here."""
        system, files = _files(self.path)
        parts = []
        for name in files:
            with system.open_input_file(name) as f:
                n = ipc.open_file(f).num_record_batches
            parts += [BatchRange(name, i, min(i + BATCHES_PER_TASK, n)) for i in range(0, n, BATCHES_PER_TASK)]
        return parts

    def read(self, partition: BatchRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no batches at all
            return
        system, _ = _open(self.path)
        with system.open_input_file(partition.file) as f:
            reader = ipc.open_file(f)
            for i in range(partition.first, partition.last):
                yield reader.get_batch(i)


@dataclass
class Written(WriterCommitMessage):
    staged: str
    final: str


class FeatherWriter(DataSourceArrowWriter):
    """Each task writes files of its own under the job's staging folder; the commit moves them into place."""

    def __init__(self, path: str, schema: pa.Schema, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, root = _open(self.path)
        # The attempt number keeps a retried or speculative task away from the files of another.
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{self.job}{SUFFIX}"
        staging = f"{root}/_staging-{self.job}"
        system.create_dir(staging, recursive=True)
        staged = f"{staging}/{name}"
        with system.open_output_stream(staged) as f, ipc.new_file(f, self.schema) as out:
            for batch in iterator:
                out.write_table(pa.Table.from_batches([batch]).cast(self.schema), max_chunksize=WRITE_ROWS)
        return Written(staged, f"{root}/{name}")

    def commit(self, messages: list[Written]) -> None:
        system, root = _open(self.path)
        done = [m for m in messages if m is not None]
        if self.overwrite:
            old = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.path.endswith(SUFFIX)]
            for name in old:
                system.delete_file(name)
        for m in done:
            system.move(m.staged, m.final)
        self._clear()

    def abort(self, messages: list[Written]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, root = _open(self.path)
        staging = f"{root}/_staging-{self.job}"
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


class FeatherDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feather"

    def schema(self):
        system, files = _files(self.options["path"])
        with system.open_input_file(files[0]) as f:
            return from_arrow_schema(ipc.open_file(f).schema)

    def reader(self, schema) -> FeatherReader:
        return FeatherReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> FeatherWriter:
        return FeatherWriter(self.options["path"], to_arrow_schema(schema), overwrite)
