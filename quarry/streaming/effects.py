"""Side effects of a stream, record by record and once per batch.

:class:`RowWriter` is a ``foreach`` writer that works in every output mode: the
rows of each (batch, run, partition) go to one file of JSON lines.  Its end tells
nothing: a worker whose input breaks off sees it end like any other.  What counts
is Spark's own note that a batch is done, which it makes when all tasks are.  So
rows are read of noted batches only, and of each only those of the last run that
wrote it; what a run left that died on the way, or before the note, is passed over.
"""

from __future__ import annotations

import json
import sys
import time
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.sources.topic import filesystem

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RowWriter:
    """Writes rows under ``path``, with ``epoch`` (their batch) and ``run``."""

    def __init__(self, path: str, run: int):
        self.path, self.run = path.rstrip("/"), run

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._fs, root = filesystem(self.path)
        self._fs.create_dir(root, recursive=True)
        self._file = f"{root}/{epoch_id:012d}-{self.run}-{partition_id:06d}.json"
        self._draft = f"{root}/.{uuid.uuid4().hex}"
        self._own = {"epoch": epoch_id, "run": self.run}
        self._out = self._fs.open_output_stream(self._draft)
        return True

    def process(self, row) -> None:
        self._out.write((json.dumps({**self._own, **row.asDict()}, ensure_ascii=False) + "\n").encode())

    def close(self, error) -> None:
        self._out.close()
        if error is None:
            self._fs.move(self._draft, self._file)  # a repeated task replaces its file
        else:
            self._fs.delete_file(self._draft)


def start_effects(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  processing_time: str | None = None) -> StreamingQuery:
    """Runs ``stream`` into the files of a :class:`RowWriter` under ``path``; columns
    must be numbers, booleans or strings."""
    query = stream.writeStream.foreach(RowWriter(path, time.time_ns())).option("checkpointLocation", checkpoint).outputMode(output_mode)
    return (query.trigger(processingTime=processing_time) if processing_time else query.trigger(availableNow=True)).start()


def noted_batches(checkpoint: str) -> int:
    """The last batch that Spark has noted as done (-1: none)."""
    from pyarrow import fs

    files, root = filesystem(f"{checkpoint.rstrip('/')}/commits")
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return max((int(f.base_name) for f in found if f.base_name.isdigit()), default=-1)


def read_effects(spark: SparkSession, path: str, checkpoint: str, schema: str) -> DataFrame:
    """The rows of every noted batch, once, with ``epoch``."""
    rows = spark.read.schema(f"epoch long, run long, {schema}").json(path).where(F.col("epoch") <= noted_batches(checkpoint))
    last = rows.groupBy("epoch").agg(F.max("run").alias("run"))
    return rows.join(last, ["epoch", "run"]).drop("run")
