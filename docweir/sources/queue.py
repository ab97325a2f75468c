"""A message queue as a streaming data source: numbered messages in files, bounded batches, acknowledged as batches are committed."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Messages of a batch, of a task that reads, and of a file. A task reads the files that its messages are in, so files don't grow with what is sent.
MOST, PER_TASK, PER_FILE = 4096, 1024, 8192


class Queue:
    """A folder of message files in any file system that pyarrow opens by its URI.

    A file's name says the number of its first message, how many it holds, and who sent them, so an
    offset is a number and finding its file opens none. What a batch sends again has the batch's tag,
    so a batch that is repeated doesn't send it twice. One process sends at a time.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder if "://" in folder else f"file://{folder}"
        self.system, self.root = fs.FileSystem.from_uri(self.folder)

    def files(self) -> list[tuple[int, int, str, str]]:
        """(first number, messages, tag, name) of every file, in order."""
        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/messages", allow_not_found=True))
        parts = [(x.base_name.removesuffix(".jsonl").split("-", 2), x.base_name) for x in found if x.base_name.endswith(".jsonl")]
        return sorted((int(first), int(rows), tag, name) for (first, rows, tag), name in parts)

    def total(self) -> int:
        return max((first + rows for first, rows, _, _ in self.files()), default=0)

    def acknowledged(self) -> int:
        """How many messages are done with, from the first on."""
        info = self.system.get_file_info(f"{self.root}/acknowledged.json")
        if info.type == fs.FileType.NotFound:
            return 0
        with self.system.open_input_stream(info.path) as file:
            return json.loads(file.read())["next"]

    def acknowledge(self, number: int) -> None:
        draft = f"{self.root}/acknowledged-{uuid.uuid4().hex}.draft"
        self.system.create_dir(self.root, recursive=True)
        with self.system.open_output_stream(draft) as file:
            file.write(json.dumps({"next": number}).encode())
        self.system.move(draft, f"{self.root}/acknowledged.json")

    def send(self, messages: DataFrame, tag: str) -> int:
        """Appends messages (message_id, deliveries, body); nothing where the tag was sent before. Returns how many.

        Tasks write the files; the driver numbers them by one row for each.
        """
        if any(t == tag for _, _, t, _ in self.files()):
            return 0
        folder = self.folder

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queue = Queue(folder)
            queue.system.create_dir(f"{queue.root}/staged", recursive=True)
            messages = (row for batch in batches for row in batch.to_pylist())
            while part := list(islice(messages, PER_FILE)):
                name = f"staged/{uuid.uuid4().hex}.jsonl"
                with queue.system.open_output_stream(f"{queue.root}/{name}") as file:
                    for row in part:
                        file.write(json.dumps(row, ensure_ascii=False).encode() + b"\n")
                yield pa.RecordBatch.from_pydict({"name": [name], "rows": pa.array([len(part)], pa.int64())})

        written = messages.select("message_id", "deliveries", "body").mapInArrow(write, "name string, rows long").collect()
        self.system.create_dir(f"{self.root}/messages", recursive=True)
        first = self.total()
        for row in sorted(written, key=lambda r: r["name"]):
            if row["rows"]:
                self.system.move(f"{self.root}/{row['name']}", f"{self.root}/messages/{first:020d}-{row['rows']}-{tag}.jsonl")
            first += row["rows"]
        return sum(r["rows"] for r in written)

    def read(self, start: int, end: int) -> Iterator[tuple]:
        for first, rows, _, name in self.files():
            if first < end and start < first + rows:
                with self.system.open_input_stream(f"{self.root}/messages/{name}") as file:
                    for number, line in enumerate(file.read().splitlines(), first):
                        if start <= number < end:
                            message = json.loads(line)
                            yield number, message["message_id"], message["deliveries"], message["body"]


class _Range(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        super().__init__((start, end))
        self.start, self.end = start, end


class QueueReader(DataSourceStreamReader):
    """Offsets are message numbers. A batch has at most `most` messages; one is acknowledged when the engine commits it, which it does as it plans the next."""

    def __init__(self, folder: str, most: int) -> None:
        self.queue, self.most, self.planned = Queue(folder), most, 0

    def initialOffset(self) -> dict:
        return {"next": self.queue.acknowledged()}

    def latestOffset(self) -> dict:
        self.planned = max(self.planned, min(self.queue.total(), max(self.planned, self.queue.acknowledged()) + self.most))
        return {"next": self.planned}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self.planned = max(self.planned, end["next"])  # after a restart, a batch that was planned before comes first
        return [_Range(a, min(a + PER_TASK, end["next"])) for a in range(start["next"], end["next"], PER_TASK)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.queue.read(partition.start, partition.end)

    def commit(self, end: dict) -> None:
        self.queue.acknowledge(max(end["next"], self.queue.acknowledged()))

    def __getstate__(self) -> dict:
        return {"folder": self.queue.folder, "most": self.most}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["folder"], state["most"])


class QueueSource(DataSource):
    """spark.readStream.format("queue").option("path", folder).option("most", n): number, message_id, deliveries, body."""

    @classmethod
    def name(cls) -> str:
        return "queue"

    def schema(self) -> str:
        return "number long, message_id string, deliveries int, body string"

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(self.options["path"], int(self.options.get("most", MOST)))


def stream(spark, folder: str, most: int = MOST) -> DataFrame:
    """The queue's messages from the first that isn't acknowledged on."""
    spark.dataSource.register(QueueSource)
    return spark.readStream.format("queue").option("path", folder).option("most", most).load()
