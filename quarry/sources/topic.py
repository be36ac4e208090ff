"""Topics as folders: keyed messages in partitions, read by offset.

``topic`` is a Spark data source (batch and streaming, read and write) over a
folder of message logs.  Messages of a partition are numbered from 0 without gaps
in the order in which they were written; a key always goes to one partition, so
its messages stay in order.

Tasks write segments, Parquet files of one partition each.  A commit, one small
JSON file, names the segments that a write adds, gives them their offsets and
holds the end of every partition after it.  What no commit names does not exist,
so a repeated or lost task leaves nothing, and a commit of a stream also names its
batch, so a repeated batch adds nothing.  One writer at a time commits to a topic.

Options: ``path``; to read, ``startingOffsets`` (``earliest``, ``latest`` or JSON
``{"0": 12, ...}``; partitions left out start at 0) and, for batches,
``endingOffsets`` (``latest`` or JSON; partitions left out go to their end); to
write a stream, ``writer`` (the name under which its batches are counted).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

from pyspark import TaskContext, cloudpickle
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# the source's classes travel to the workers whole, so these need no package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

READ_SCHEMA = "partition int, offset long, key string, value string"
#: Messages that one task reads, and messages of a row group, at most.
SPLIT = 1_000_000
ROW_GROUP = 65_536


def filesystem(path: str):
    """(Arrow file system, path inside it) of a URI or plain path."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class TopicLog:
    """The commits of a topic."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.fs, self.root = filesystem(self.path)

    def names(self) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def commit(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.root}/commits/{name}") as f:
            return json.loads(f.read())

    def last_first(self) -> Iterator[dict]:
        return (self.commit(name) for name in reversed(self.names()))

    def ends(self) -> dict[str, int]:
        """The offset after the last message of each partition."""
        return next((c["ends"] for c in self.last_first()), {})

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[tuple[str, str, int, int, int]]:
        """(file, partition, first offset, from, to) of the segments with offsets
        between ``start`` and ``end``; older commits are not looked at."""
        found = []
        for commit in self.last_first():
            for partition, first, count, name in commit["segments"]:
                a, b = max(first, start.get(partition, 0)), min(first + count, end.get(partition, 0))
                if a < b:
                    found.append((f"{self.path}/segments/{name}", partition, first, a, b))
            firsts = {}
            for partition, first, _, _ in commit["segments"]:
                firsts[partition] = min(first, firsts.get(partition, first))
            before = {**commit["ends"], **firsts}
            if all(start.get(p, 0) >= n for p, n in before.items()):
                break
        return sorted(found, key=lambda s: (int(s[1]), s[3]))

    def batch_of(self, writer: str) -> int:
        """The last batch that ``writer`` has committed (-1: none)."""
        return next((c["batch"][1] for c in self.last_first() if c.get("batch") and c["batch"][0] == writer), -1)

    def add(self, written: list[list], batch: list | None = None) -> None:
        """Commits segments [partition, count, file], in their order."""
        names = self.names()
        ends = dict(self.commit(names[-1])["ends"]) if names else {}
        segments = []
        for partition, count, name in written:
            first = ends.get(partition, 0)
            segments.append([partition, first, count, name])
            ends[partition] = first + count
        number = int(names[-1].split(".")[0]) + 1 if names else 0
        content = json.dumps({"segments": segments, "ends": ends, "batch": batch}).encode()
        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        draft = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(content)
        self.fs.move(draft, f"{self.root}/commits/{number:020d}.json")

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.fs.delete_file(f"{self.root}/segments/{name}")


def _offsets(text: str, latest) -> dict[str, int]:
    if text == "earliest":
        return {}
    return latest() if text == "latest" else {str(int(p)): int(n) for p, n in json.loads(text).items()}


class Segment(InputPartition):
    """A range of offsets of one segment."""

    def __init__(self, file: str, partition: str, first: int, start: int, end: int):
        self.file, self.partition, self.first, self.start, self.end = file, partition, first, start, end


def _plan(log: TopicLog, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
    return [Segment(file, p, first, k, min(b, k + SPLIT))
            for file, p, first, a, b in log.segments(start, end) for k in range(a, b, SPLIT)]


def _read(part: Segment):
    """The messages of a range; row groups outside it are not read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    fs, inner = filesystem(part.file)
    with fs.open_input_file(inner) as f:
        file = pq.ParquetFile(f)
        at = part.first
        for group in range(file.num_row_groups):
            size = file.metadata.row_group(group).num_rows
            a, b = max(part.start, at), min(part.end, at + size)
            if a < b:
                rows = file.read_row_group(group, ["key", "value"]).slice(a - at, b - a)
                offset = a
                for batch in rows.to_batches():
                    n = batch.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(part.partition)] * n, pa.int32()), pa.array(range(offset, offset + n), pa.int64()),
                         batch.column(0).cast(pa.string()), batch.column(1).cast(pa.string())],
                        names=["partition", "offset", "key", "value"])
                    offset += n
            at += size


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.log = options["path"]
        self.start = options.get("startingOffsets", "earliest")
        self.end = options.get("endingOffsets", "latest")

    def partitions(self) -> list[Segment]:
        log = TopicLog(self.log)
        ends = log.ends()
        end = {**ends, **{p: min(n, ends.get(p, 0)) for p, n in _offsets(self.end, lambda: ends).items()}}
        return _plan(log, _offsets(self.start, lambda: ends), end) or [Segment("", "0", 0, 0, 0)]

    def read(self, partition: Segment):
        return _read(partition) if partition.file else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log, self.start = options["path"], options.get("startingOffsets", "latest")

    def initialOffset(self) -> dict:
        ends = TopicLog(self.log).ends()
        start = _offsets(self.start, lambda: ends)
        return {"ends": {**{p: 0 for p in ends}, **start}}

    def latestOffset(self) -> dict:
        return {"ends": TopicLog(self.log).ends()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return _plan(TopicLog(self.log), start["ends"], end["ends"])

    def read(self, partition: Segment):
        return _read(partition)


class Written(WriterCommitMessage):
    """The segments that a task has written, as [partition, count, file]."""

    def __init__(self, task: int, segments: list[list]):
        self.task, self.segments = task, segments


class _Writer:
    """Writes the rows (partition, key, value) of a task to new segments."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> Written:
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        fs, root = filesystem(self.path.rstrip("/"))
        fs.create_dir(f"{root}/segments", recursive=True)
        held: dict[int, list] = {}  # rows of a partition not yet written: less than a row group and a batch
        files: dict[int, list] = {}

        def flush(p: int) -> None:
            rows = pa.Table.from_batches(held.pop(p))
            if p not in files:
                name = f"{p:05d}-{uuid.uuid4().hex}.parquet"
                files[p] = [name, 0, pq.ParquetWriter(fs.open_output_stream(f"{root}/segments/{name}"), rows.schema)]
            files[p][1] += rows.num_rows
            files[p][2].write_table(rows, row_group_size=ROW_GROUP)

        for batch in iterator:
            columns = {name.lower(): batch.column(k) for k, name in enumerate(batch.schema.names)}
            place = columns["partition"].to_numpy(zero_copy_only=False)
            rows = pa.RecordBatch.from_arrays([columns["key"].cast(pa.string()), columns["value"].cast(pa.string())], ["key", "value"])
            for p in np.unique(place).tolist():
                held.setdefault(int(p), []).append(rows.take(pa.array(np.flatnonzero(place == p))))
                if sum(x.num_rows for x in held[int(p)]) >= ROW_GROUP:
                    flush(int(p))
        for p in sorted(held):
            flush(p)
        for _, _, file in files.values():
            sink = file.file_handle
            file.close()
            if sink is not None and not sink.closed:
                sink.close()
        return Written(TaskContext.get().partitionId(), [[str(p), n, name] for p, (name, n, _) in sorted(files.items())])


def _in_task_order(messages) -> list[list]:
    return [s for m in sorted((m for m in messages if m is not None), key=lambda m: m.task) for s in m.segments]


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        TopicLog(self.path).add(_in_task_order(messages))

    def abort(self, messages) -> None:
        TopicLog(self.path).drop([name for _, _, name in _in_task_order(messages)])


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str):
        super().__init__(path)
        self.writer = writer

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        log, segments = TopicLog(self.path), _in_task_order(messages)
        if batchId <= log.batch_of(self.writer):  # done before the query was stopped
            log.drop([name for _, _, name in segments])
        else:
            log.add(segments, [self.writer, batchId])

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        TopicLog(self.path).drop([name for _, _, name in _in_task_order(messages)])


class TopicSource(DataSource):
    """``spark.read/readStream/write/writeStream.format("topic")``; rows to write
    have the columns partition (int), key and value."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):  # noqa: N802
        return _StreamReader(self.options)

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a topic is only appended to")
        return _BatchWriter(self.options["path"])

    def streamWriter(self, schema, overwrite: bool):  # noqa: N802
        return _StreamWriter(self.options["path"], self.options.get("writer", "stream"))
