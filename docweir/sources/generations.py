"""A data sink whose generations are whole or absent: tasks write beside what counts, and one commit checks and publishes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


class Incomplete(RuntimeError):
    """What tasks wrote isn't what was to be written; the generation before still counts."""


@dataclass
class Written(WriterCommitMessage):
    """A task's file and its rows."""

    file: str
    rows: int


class Generations:
    """A folder of generations; current.json names the files of the one that counts."""

    def __init__(self, folder: str) -> None:
        self.folder = folder if "://" in folder else f"file://{folder}"
        self.system, self.root = fs.FileSystem.from_uri(self.folder)

    def current(self) -> dict:
        info = self.system.get_file_info(f"{self.root}/current.json")
        if info.type == fs.FileType.NotFound:
            return {"generation": "", "files": []}
        with self.system.open_input_stream(info.path) as file:
            return json.loads(file.read())

    def publish(self, generation: str, files: list[str]) -> None:
        draft = f"{self.root}/current-{uuid.uuid4().hex}.draft"
        with self.system.open_output_stream(draft) as file:
            file.write(json.dumps({"generation": generation, "files": sorted(files)}).encode())
        self.system.move(draft, f"{self.root}/current.json")

    def drop(self, generation: str) -> None:
        if generation and self.system.get_file_info(f"{self.root}/{generation}").type == fs.FileType.Directory:
            self.system.delete_dir(f"{self.root}/{generation}")

    def read(self, spark: SparkSession, schema) -> DataFrame:
        files = self.current()["files"]
        return spark.read.schema(schema).parquet(*(f"{self.folder}/{f}" for f in files)) if files else spark.createDataFrame([], schema)


class GenerationWriter(DataSourceArrowWriter):
    """First phase: each task writes a file of its own. Second: the driver counts rows in the files' footers, compares them with what tasks
    say and with what is expected, publishes the list, and only then removes the generation before."""

    def __init__(self, folder: str, expected: int | None) -> None:
        self.folder, self.expected, self.generation = folder, expected, f"generation-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store = Generations(self.folder)
        store.system.create_dir(f"{store.root}/{self.generation}", recursive=True)
        name, writer, rows = f"{self.generation}/{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if writer is None:
                    writer = pq.ParquetWriter(f"{store.root}/{name}", batch.schema, filesystem=store.system)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        store = Generations(self.folder)
        files = [m.file for m in messages if m is not None and m.file]
        claimed = sum(m.rows for m in messages if m is not None)
        there = sum(pq.read_metadata(f"{store.root}/{f}", filesystem=store.system).num_rows for f in files)
        if there != claimed or self.expected not in (None, there):
            raise Incomplete(f"{there} rows are stored, {claimed} were written, {self.expected} are expected")
        before = store.current()["generation"]
        store.publish(self.generation, files)
        store.drop(before)

    def abort(self, messages: list[Written | None]) -> None:
        Generations(self.folder).drop(self.generation)


class GenerationSink(DataSource):
    """df.write.format("generation").option("path", folder).option("expected", rows).mode("append").save()."""

    @classmethod
    def name(cls) -> str:
        return "generation"

    def writer(self, schema, overwrite: bool) -> GenerationWriter:
        expected = self.options.get("expected")
        return GenerationWriter(self.options["path"], int(expected) if expected is not None else None)


def replace(rows: DataFrame, folder: str, expected: int | None = None) -> None:
    """Makes rows the generation that counts; what fails on the way leaves the one before."""
    rows.sparkSession.dataSource.register(GenerationSink)
    writer = rows.write.format("generation").option("path", folder).mode("append")
    (writer.option("expected", expected) if expected is not None else writer).save()
