"""Shared helpers: bounded text slices, vectorised word hashes, written tables,
and files in the cluster's shared folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import quarry
from quarry.session import scratch_path

SLICE_BYTES = 1 << 20

#: White space of the word rules: space and the bytes 9 to 13.
WORD_SEPARATORS = bytes([0x20, 9, 10, 11, 12, 13])
SPACES = "[\\x20\\x09-\\x0D]+"

_RNG = np.random.RandomState(20240607)
_BYTE_VALUES = _RNG.randint(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python workers, once per application
    (as ``--py-files`` would), so that tasks import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(quarry.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quarry-ship-")).resolve() / "quarry_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables of ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def python_batches(spark: SparkSession, rows: int | None):
    """Within it at most ``rows`` rows (None: as set) reach a Python worker at a time."""
    before = spark.conf.get(ARROW_ROWS)
    if rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def written(df: DataFrame, kind: str, arrow_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again (cuts lineage);
    ``arrow_rows`` bounds the rows that reach a Python worker at a time."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{kind}")
    with python_batches(spark, arrow_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks over which a hot key is dealt out.
SALTS = 16


def heavy(rows: DataFrame, key: str) -> list[int]:
    """The keys (long) that may hold more than a ``HOT_KEYS``-th of ``rows``, by a
    sketch of fixed size: fewer than ``HOT_KEYS`` numbers, whatever the data."""
    found = rows.agg(F.expr(f"approx_top_k({key}, {HOT_KEYS}, {8 * HOT_KEYS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(x["item"] for x in found["top"] or [] if x["item"] is not None and x["count"] * HOT_KEYS > found["n"])


def salted_join(rows: DataFrame, other: DataFrame, key: str, hot: list[int], by: str) -> DataFrame:
    """Inner join on ``key``; rows of ``hot`` keys are dealt out over ``SALTS`` tasks by
    their column ``by``, and the other side's are repeated for each."""
    if not hot:
        return rows.join(other, key)
    is_hot = F.col(key).isin(hot)
    left = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(0).cast("int"))
    every = F.when(is_hot, F.array(*[F.lit(k) for k in range(SALTS)])).otherwise(F.array(F.lit(0)))
    return left.join(other.withColumn("_salt", F.explode(every)), [key, "_salt"]).drop("_salt")


#: Keys that join by broadcast in :func:`join_split`, at most.
HOT_KEYS = 1000


def join_split(rows: DataFrame, unique: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``unique`` (one row per key), with hot keys apart.

    ``counts`` (keys, rows) tells how many of the ``total`` rows each key has.
    Keys with more than a ``HOT_KEYS``-th of them, so fewer than ``HOT_KEYS``
    whatever the data, join by broadcast; no other key is large.
    """
    hot = F.broadcast(unique.join(counts.where(F.col("rows") * HOT_KEYS > total).select(*keys), keys, "left_semi"))
    some = rows.join(hot, keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(unique, keys)
    return some.unionByName(rest)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


def buffers_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (starting at 0) of a string array without nulls."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    at = at.astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]), at - at[0]


def slices(batches, column: str, limit: int = SLICE_BYTES):
    """Row slices of Arrow batches with at most about ``limit`` bytes in
    ``column`` (one longer text forms a slice of its own)."""
    for batch in batches:
        texts = text_column(batch, column)
        _, at = buffers_of(texts)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        found = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            found.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


class WordHasher:
    """64-bit hashes of the words of texts given as one byte buffer.

    A word is a run of bytes outside ``separators``; A-Z count as a-z.  The
    hash of a word is a polynomial of its bytes, got for all words at once
    from running sums, so no Python code runs per word or per text.
    """

    def __init__(self, separators: bytes = WORD_SEPARATORS, fold: bool = True):
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        self.values = _BYTE_VALUES.copy()
        if fold:
            self.values[65:91] = self.values[97:123]

    def __call__(self, data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20):
        """(hash of each word, first byte of each word, words before each offset)."""
        hashes, starts, begin = [], [], 0
        n = len(data)
        while begin < n:
            end = min(n, begin + limit)
            if end < n:
                inner = np.flatnonzero(self.separator[data[begin:end]])
                if len(inner):
                    end = begin + int(inner[-1]) + 1
                else:  # one word longer than the limit: up to its end
                    while end < n and not self.separator[data[end]]:
                        end += 1
            h, s = self._chunk(data[begin:end], offsets - begin)
            hashes.append(h)
            starts.append(s + begin)
            begin = end
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        return hashes, starts, np.searchsorted(starts, offsets)

    def _chunk(self, data: np.ndarray, cuts: np.ndarray):
        n = len(data)
        word = ~self.separator[data]
        first, last = word.copy(), word.copy()
        cuts = cuts[(cuts > 0) & (cuts < n)]
        first[1:] &= ~word[:-1]
        first[cuts] = word[cuts]
        last[:-1] &= ~word[1:]
        last[cuts - 1] = word[cuts - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * power[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * _GOLDEN), starts


def span_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, check value) of the byte spans between the places ``at``;
    the check value holds the span's length, first four and last four bytes."""
    n = len(data)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:n], out=sums[1:])
    starts, ends = at[:-1], at[1:]
    size = (ends - starts).astype(np.uint64)
    check = size * _GOLDEN
    for k in range(4):
        inside = size > np.uint64(k)
        near = np.minimum(starts + k, n - 1)
        check ^= np.where(inside, data[near], 0).astype(np.uint64) << np.uint64(8 * k)
        near = np.maximum(ends - 1 - k, 0)
        check ^= np.where(inside, data[near], 0).astype(np.uint64) << np.uint64(32 + 8 * k)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + size), check


BITMAP_BITS = 24


def bitmap(places: DataFrame) -> np.ndarray:
    """2 MB with the bits set that the int column of ``places`` names; at most
    2^BITMAP_BITS numbers reach the driver, however long ``places`` is."""
    flags = np.zeros(1 << BITMAP_BITS, bool)
    flags[places.distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(flags, bitorder="little")


def in_bitmap(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


# Files in the shared folder -------------------------------------------------

def filesystem(path: str):
    """(Arrow file system, path inside it) of a URI or plain path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class NewFile:
    """A file that exists under a unique name only once it is whole.

    Every attempt of a task writes a file of its own; the path reaches the
    manifest through Spark's committed output only, so what a lost or repeated
    attempt has left is never read.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.path = posixpath.join(folder, f"{stem}-{uuid.uuid4().hex}{suffix}")
        self._fs, inner = filesystem(self.path)
        self._fs.create_dir(posixpath.dirname(inner), recursive=True)
        self._out = self._fs.open_output_stream(inner, compression=None)
        self.size = 0

    def write(self, data) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()


def open_file(path: str):
    """A random-access reader of ``path``."""
    fs, inner = filesystem(path)
    return fs.open_input_file(inner)
