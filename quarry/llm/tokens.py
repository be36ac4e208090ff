"""Token ids of documents, stored as directly addressable codes.

An id is cut into chunks of ``LEVEL_BITS`` bits, lowest first.  Level ``l``
holds chunk ``l`` of every id that needs more than ``l`` chunks, as bytes; a
continuation bitmap per level marks the ids that go on to the next level, and a
rank directory holds the number of marked ids before each 512-bit block.  The
place of an id's next chunk is a rank, so any token is read with one byte, one
bitmap block and one directory entry per level; no block is decoded.

Documents lie in ascending ``doc_id`` order over shards (one range of ids per
task) and segments (whole documents, about ``SEGMENT_TOKENS`` ids).  A null
text counts as empty, a null ``doc_id`` sorts first, repeated ids lie side by
side in the order of their texts' hashes, other columns are not read, and a
table without rows gives a store without segments.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.session import scratch_path

MAGIC = b"DACS0001"
LEVEL_BITS = 8
BLOCK_BITS = 512
SEGMENT_TOKENS = 1 << 18
END_ID = 0
SLOTS = 1 << 20
POOL_IDS = 6 << 20
#: Texts are taken in slices of so many bytes, from batches of so many rows.
SCAN_BYTES = 1 << 18
SCAN_ROWS = 2000
MANIFEST = "shard int, seq int, path string, docs long, tokens long"


# The code -------------------------------------------------------------------

def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk bytes, packed continuation bits, rank directory) of each level."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while True:
        chunk = (rest & np.uint32(0xFF)).astype(np.uint8)
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = -(-len(more) // BLOCK_BITS)
        padded = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
        padded[: len(bits)] = bits
        counts = _ones(padded).reshape(blocks, -1).sum(1, dtype=np.uint32) if blocks else np.zeros(0, np.uint32)
        rank = np.zeros(blocks + 1, np.uint32)
        np.cumsum(counts, out=rank[1:])
        levels.append((chunk, padded, rank))
        if not rank[-1]:
            return levels
        rest = rest[more] >> np.uint32(LEVEL_BITS)


def _ones(packed: np.ndarray) -> np.ndarray:
    return np.bitwise_count(packed)


def segment_bytes(ids: np.ndarray, doc_ids: np.ndarray, valid: np.ndarray, lengths: np.ndarray) -> bytes:
    """One segment: header, documents (id, validity, first token), levels."""
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    levels = encode_levels(ids)
    parts = [MAGIC, struct.pack("<III", len(doc_ids), len(ids), len(levels)),
             doc_ids.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(), starts.astype("<i8").tobytes()]
    for chunk, bits, rank in levels:
        parts += [struct.pack("<II", len(chunk), len(bits)), rank.astype("<u4").tobytes(), bits.tobytes(), chunk.tobytes()]
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


class Segment:
    """A segment inside a random-access file; ``base`` is its first byte."""

    def __init__(self, source, base: int = 0):
        self._source = source
        head = self._read(base, len(MAGIC) + 12)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token segment")
        self.docs, self.tokens, n_levels = struct.unpack("<III", head[len(MAGIC):])
        at = base + len(head)
        self.doc_ids = np.frombuffer(self._read(at, 8 * self.docs), "<i8")
        at += 8 * self.docs
        self.valid = np.frombuffer(self._read(at, self.docs), np.uint8).astype(bool)
        at += self.docs
        self.starts = np.frombuffer(self._read(at, 8 * self.docs + 8), "<i8")
        at += 8 * self.docs + 8
        self.levels = []
        for _ in range(n_levels):
            n, n_bits = struct.unpack("<II", self._read(at, 8))
            ranks = 4 * (n_bits * 8 // BLOCK_BITS + 1)
            self.levels.append((n, at + 8, at + 8 + ranks, at + 8 + ranks + n_bits))
            at += 8 + ranks + n_bits + n
        self.end = at + 4
        self._base = base

    def _read(self, at: int, n: int) -> bytes:
        self._source.seek(at)
        got = self._source.read(n)
        if len(got) != n:
            raise ValueError("a token segment is cut short")
        return got

    def token(self, i: int) -> int:
        """Token ``i`` of the segment, by rank; reads a few bytes per level."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level, (_, ranks, bits, chunks) in enumerate(self.levels):
            value |= self._read(chunks + i, 1)[0] << (LEVEL_BITS * level)
            block, inside = divmod(i, BLOCK_BITS)
            word = np.frombuffer(self._read(bits + block * (BLOCK_BITS // 8), BLOCK_BITS // 8), np.uint8)
            if not word[inside // 8] >> (inside % 8) & 1:
                return value
            before = np.unpackbits(word, bitorder="little")[:inside].sum()
            i = struct.unpack("<I", self._read(ranks + 4 * block, 4))[0] + int(before)
        raise ValueError("a continuation bit is set on the last level")

    def ids(self) -> np.ndarray:
        """All ids of the segment (for full scans), after its checksum is tested."""
        whole = self._read(self._base, self.end - self._base)
        if zlib.crc32(whole[:-4]) != struct.unpack("<I", whole[-4:])[0]:
            raise ValueError("a token segment has a wrong checksum")
        rest = None
        for n, ranks, bits, chunks in reversed(self.levels):
            chunk = np.frombuffer(whole, np.uint8, n, chunks - self._base).astype(np.uint32)
            if rest is not None:
                packed = np.frombuffer(whole, np.uint8, chunks - bits, bits - self._base)
                more = np.unpackbits(packed, count=n, bitorder="little").view(bool)
                chunk[more] |= rest << np.uint32(LEVEL_BITS)
            rest = chunk
        return rest if rest is not None else np.zeros(0, np.uint32)


# Tokenizing -----------------------------------------------------------------

class Encoder:
    """The ids that the tokenizers library gives for whole texts, found once per
    distinct word.

    No pre-token of a byte-level vocabulary runs over the place between a
    character and a white-space run, so a text's ids are the ids of its pieces
    (white space and what follows it), one after another.  Pieces met before
    come from a table of ``SLOTS`` places; a piece is the stored one if a 64-bit
    hash of its bytes, its length, and its first and last four bytes agree.
    The others are encoded together and cut apart by the byte lengths of their
    tokens.  Added tokens (as special ones are) have no white space, so each lies
    within a piece and gets its own id, as from the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if token.lstrip or token.rstrip or token.single_word or re.search(r"\s", token.content):
                raise ValueError("an added token looks beyond its own characters")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # one character stands for one byte
            self.lengths[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.hash, self.check = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.first, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int32)

    @staticmethod
    def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First bytes of pieces: text starts, and white space after a character
        that surely is none (ASCII, or of two bytes from U+00C0 on)."""
        n = len(data)
        start = np.zeros(n, bool)
        if n > 1:
            space = (data == 0x20) | ((data >= 9) & (data <= 13))
            start[1:] = space[1:] & (data[:-1] > 0x20) & (data[:-1] < 0x80)
            start[2:] |= space[2:] & (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
        start[offsets[:-1][offsets[:-1] < n]] = True
        return np.flatnonzero(start)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        data, offsets = common.buffers_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = self.piece_starts(data, offsets)
        starts = np.append(starts, len(data))
        ids, counts, k = [], [], 0
        while k < len(starts) - 1:
            upto = max(k + 1, int(np.searchsorted(starts, starts[k] + SCAN_BYTES, "right")) - 1)
            found = self._pieces(data[starts[k]: starts[upto]], starts[k: upto + 1] - starts[k])
            ids.append(found[0])
            counts.append(found[1])
            k = upto
        total = np.zeros(len(starts), np.int64)
        np.cumsum(np.concatenate(counts), out=total[1:])
        return np.concatenate(ids), np.diff(total[np.searchsorted(starts, offsets)])

    def _pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.used > POOL_IDS:
            self._forget()
        hashes, checks = common.span_hashes(data, at)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        hit = (self.hash[slot] == hashes) & (self.check[slot] == checks)
        first, count = self.first[slot], self.count[slot].astype(np.int64)
        if not hit.all():
            new = np.flatnonzero(~hit)
            _, one, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            if not np.array_equal(checks[new[one]][which], checks[new]):  # equal hashes of different pieces
                one, which = np.arange(len(new)), np.arange(len(new))
            chosen = new[one]
            raw, bounds = data.tobytes(), at.tolist()
            found = self._encode([raw[bounds[k]: bounds[k + 1]] for k in chosen])
            self._store(slot[chosen], hashes[chosen], checks[chosen], *found)
            first[new], count[new] = found[0][which], found[1][which]
        return self._gather(self.pool, first, count), count

    @staticmethod
    def _gather(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        ends = np.cumsum(count)
        return pool[np.repeat(first - (ends - count), count) + np.arange(ends[-1])]

    def _store(self, slot, hashes, checks, first, count) -> None:
        slot, one = np.unique(slot, return_index=True)
        self.hash[slot], self.check[slot] = hashes[one], checks[one]
        self.first[slot], self.count[slot] = first[one], count[one]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the pool of new pieces' ids; the pieces are joined wherever
        no pre-token can run over the joint, and encoded."""
        groups, size, joins = [], 0, False
        for word in words:
            if not joins or size > 1 << 14 or word[0] not in common.WORD_SEPARATORS:
                groups.append([])
                size = 0
            groups[-1].append(word)
            size += len(word)
            joins = 0x20 < word[-1] < 0x80 or (word[-1] >= 0x80 and 0xC3 <= word[-2] <= 0xDF)
        texts = [b"".join(g).decode("utf-8") for g in groups]
        parts = []
        for k in range(0, len(texts), 16):  # the library's results are much larger than the ids
            done = self.tokenizer.encode_batch_fast(texts[k: k + 16], add_special_tokens=False)
            parts += [np.asarray(x.ids, np.uint32) for x in done]
        ids = np.concatenate(parts)
        ends = np.cumsum(self.lengths[ids])
        wanted = np.cumsum(np.fromiter((len(w) for w in words), np.int64, len(words)))
        cut = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[cut], wanted):
            raise ValueError("a token runs over the end of a piece")
        if self.used + len(ids) > len(self.pool):
            grown = np.zeros(max(2 * len(self.pool), self.used + len(ids)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used: self.used + len(ids)] = ids
        cut = np.insert(cut + 1, 0, 0) + self.used
        self.used += len(ids)
        return cut[:-1], np.diff(cut)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; its word cache is bounded and kept between tasks.  It
    runs in the task's own thread: each of the library's would hold memory of its own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# The store ------------------------------------------------------------------

def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Encodes ``docs`` (doc_id, text), appends ``END_ID`` to each document and
    writes one file per shard into ``folder``; returns the manifest.

    The only shuffle deals the texts out by ranges of ``doc_id``.  A shard is
    written by streaming, a segment at a time.
    """
    spark = docs.sparkSession
    common.ship(spark)
    folder = folder or scratch_path(spark, "llm/tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    keys = ["doc_id", "_tie"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie")

    def shards(batches):
        from pyspark import TaskContext

        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer_path)
        out, docs_in, tokens_in = None, 0, 0
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal held, size, out, docs_in, tokens_in
            if not held:
                return
            if out is None:
                out = common.NewFile(folder, f"shard-{shard:06d}", ".dac")
            ids = np.concatenate([h[0] for h in held])
            out.write(segment_bytes(ids, *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3))))
            docs_in += sum(len(h[1]) for h in held)
            tokens_in += len(ids)
            held, size = [], 0

        for part in common.slices(batches, "text", SCAN_BYTES):
            ids, counts = encode(common.text_column(part, "text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, END_ID)
            doc = part.column(0)
            held.append((ids, doc.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(doc.is_valid()), counts + 1))
            size += len(ids)
            if size >= SEGMENT_TOKENS:
                flush()
        flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((shard, pa.int32()), (0, pa.int32()), (out.path, pa.string()),
                                               (docs_in, pa.int64()), (tokens_in, pa.int64()))],
                names=["shard", "seq", "path", "docs", "tokens"])

    return common.written(rows.mapInArrow(shards, MANIFEST), "token_manifest", SCAN_ROWS)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Reads every file of a manifest: doc_id, start (ids of all documents
    before), n_tokens and ids_crc32 per document, in no given order.

    Only the manifest (one row per shard) is summed over in one task.
    """
    spark = manifest.sparkSession
    common.ship(spark)
    order = Window.orderBy("shard", "seq")
    bases = manifest.select("shard", "path", (F.sum("tokens").over(order) - F.col("tokens")).alias("base"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def documents(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with common.open_file(path) as source:
                    at, total, before = 0, source.size(), base
                    while at < total:
                        segment = Segment(source, at)
                        ids = segment.ids().astype("<u4", copy=False)
                        raw, cuts = memoryview(ids).cast("B"), segment.starts * 4
                        sums = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())),
                                           np.int64, segment.docs)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(segment.doc_ids, mask=~segment.valid), pa.array(segment.starts[:-1] + before),
                             pa.array(np.diff(segment.starts)), pa.array(sums)],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        before += segment.tokens
                        at = segment.end

    return (bases.select("path", "base").repartition(n)
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_at(manifest: DataFrame, position: int) -> int:
    """The token at a global position, read by random access from its shard."""
    if position < 0:
        raise IndexError(position)
    order = Window.orderBy("shard", "seq")
    end = F.sum("tokens").over(order)
    row = (manifest.select("path", (end - F.col("tokens")).alias("base"), end.alias("end"))
           .where((F.col("base") <= position) & (F.col("end") > position)).first())
    if row is None:
        raise IndexError(position)
    with common.open_file(row["path"]) as source:
        at, inside = 0, position - row["base"]
        while True:
            segment = Segment(source, at)
            if inside < segment.tokens:
                return segment.token(inside)
            inside -= segment.tokens
            at = segment.end
