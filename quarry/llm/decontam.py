"""Benchmark decontamination by spaced seeds.

A mask looks at 7 of 9 words in a row and ignores the others, so a seed still
hits where some words were replaced; every overlap meets one of the masks, so
none is lost.  Seeds of all windows of the benchmark are
stored by hash; bitmaps of their hashes (of fixed size, whatever the size of the
benchmark) sort out windows of documents inside the scan, and only documents
with windows that may hit go on, with those windows, to be joined to the stored
seeds.  Around each hit the document and the item are laid side by side; they
overlap if a stretch has enough equal words.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.common import written

#: A stretch counts +1 for an equal word and -2 for another; it is an overlap
#: with this many equal words, or all of a shorter item's.
LEAST_EQUAL = 10
MISS = 2
#: Items with fewer words prove nothing; those with fewer than LEAST_EQUAL are
#: hit by all their words.
LEAST_WORDS = 5
#: Masks over SPAN words (1: the word counts).  A best stretch counts more than 0
#: from each of its words to its end, so its k-th other word from the end lies
#: more than 3k places before the end: the last three words are equal, and of the
#: last nine at most two are not, one of them beyond the sixth.  These are all
#: such endings (one with fewer other words meets several).
SPAN = 9
MASKS = tuple("".join("01"[k not in others] for k in range(SPAN, 0, -1))
              for others in [(i, j) for j in (7, 8, 9) for i in range(4, j)])

#: Seeds with more than such a part of all hits are dealt out over so many tasks.
HOT_SEEDS, SALTS = 1000, 16

#: Words are runs of ASCII letters and digits and of non-ASCII characters.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_FACTORS = np.random.RandomState(77).randint(1, 2**62, 64, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def text_words(texts: pa.Array, hasher=common.WordHasher(SEPARATORS)) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts in lower case, words before each text)."""
    words, _, bounds = hasher(*common.buffers_of(pc.utf8_lower(texts)))
    return words, bounds


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed hash (int64) of every window of ``len(mask)`` words."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, (int(mask, 2) << 8) + len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h += words[k: k + n] * _FACTORS[k]
    return common.mixed(h).view(np.int64)


def mask_seeds(words: np.ndarray):
    """The seeds of every mask in turn; the masks share their products."""
    n = len(words) - SPAN + 1
    if n <= 0:
        yield from (np.zeros(0, np.int64) for _ in MASKS)
        return
    parts = [words[k: k + n] * _FACTORS[k] for k in range(SPAN)]
    whole = sum(parts[1:], parts[0])
    for mask in MASKS:
        h = whole + np.uint64((int(mask, 2) << 8) + SPAN)
        for k, bit in enumerate(mask):
            if bit == "0":
                h -= parts[k]
        yield common.mixed(h).view(np.int64)


# The benchmark ---------------------------------------------------------------

def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words): one row per different sequence of words; item_id
    is the smallest of the rows that have it.  Items with fewer than
    ``LEAST_WORDS`` words prove nothing and are left out."""
    common.ship(benchmark.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def words_of(batches):
        for part in common.slices(batches, "text"):
            words, at = text_words(part.column(1))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["item_id", "words"])

    found = rows.mapInArrow(words_of, "item_id long, words array<long>").where(F.size("words") >= LEAST_WORDS)
    items = found.groupBy("words").agg(F.min("item_id").alias("item_id"))
    return items.select(F.xxhash64(F.col("words")).alias("item"), "item_id", "words")


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, place) of all windows of the items."""
    def rows(batches):
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = np.array(words, np.int64).view(np.uint64)
                found = list(mask_seeds(w)) if len(w) >= LEAST_EQUAL else [seeds(w, "1" * len(w))]
                place = np.concatenate([np.arange(len(f)) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), pa.array(np.full(len(place), item, np.int64)), pa.array(place)],
                    names=["seed", "item", "place"])

    return items.select("item", "words").mapInArrow(rows, "seed long, item long, place long")


def seed_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits that stand for a seed: its upper and its lower ones."""
    u = h.view(np.uint64)
    return ((u >> np.uint64(64 - common.BITMAP_BITS)).astype(np.int64),
            (u & np.uint64((1 << common.BITMAP_BITS) - 1)).astype(np.int64))


def seed_bitmaps(stored: DataFrame) -> list[np.ndarray]:
    """A bitmap of each of the two bits of the stored seeds."""
    upper = F.shiftrightunsigned("seed", 64 - common.BITMAP_BITS)
    lower = F.col("seed").bitwiseAND(F.lit((1 << common.BITMAP_BITS) - 1))
    return [common.bitmap(stored.select(place.cast("int"))) for place in (upper, lower)]


# Documents -------------------------------------------------------------------

def row_key(doc_id: Column, text: Column) -> Column:
    """A hash of a row's id and text, the same in every run."""
    return F.xxhash64(doc_id, text)


SUSPECTS = "key long, doc_id long, text string, seeds array<long>, places array<long>"


def suspects(docs: DataFrame, bitmaps: list[np.ndarray], short: list[int]) -> DataFrame:
    """(key, doc_id, text, seeds, places) of the documents with windows whose
    seeds are in both bitmaps, and those seeds with their word places."""
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")

    def search(batches):
        for part in common.slices(batches, "text"):
            words, at = text_words(common.text_column(part, "text"))
            docs_hit, seeds_hit, places_hit = [], [], []
            whole = ((n, seeds(words, "1" * n)) for n in short)
            for span, found in chain(((SPAN, s) for s in mask_seeds(words)), whole):
                upper, lower = seed_places(found)
                hit = np.flatnonzero(common.in_bitmap(bitmaps[0], upper))
                hit = hit[common.in_bitmap(bitmaps[1], lower[hit])]
                doc = np.searchsorted(at, hit, "right") - 1
                inside = hit + span <= at[doc + 1]  # windows do not run over a text's end
                hit, doc = hit[inside], doc[inside]
                docs_hit.append(doc)
                seeds_hit.append(found[hit])
                places_hit.append(hit - at[doc])
            doc = np.concatenate(docs_hit)
            if not len(doc):
                continue
            order = np.argsort(doc, kind="stable")
            own, first = np.unique(doc[order], return_index=True)
            cuts = pa.array(np.append(first, len(order)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x)[order])) for x in (seeds_hit, places_hit)]
            chosen = part.take(pa.array(own))
            yield pa.RecordBatch.from_arrays([*chosen.columns, *lists], names=["key", "doc_id", "text", "seeds", "places"])

    return rows.mapInArrow(search, SUSPECTS)


def best_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(equal words, first, end) of the best stretch with item word 0 at ``shift``."""
    a, b = max(0, shift), min(len(doc), shift + len(item))
    if b <= a:
        return 0, 0, 0
    equal = doc[a:b] == item[a - shift: b - shift]
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISS))])
    end = int(np.argmax(score - np.minimum.accumulate(score)))
    first = int(np.argmin(score[: end + 1]))
    return int(equal[first:end].sum()), a + first, a + end


def seed_pairs(hits: DataFrame, stored: DataFrame) -> DataFrame:
    """``hits`` (key, seed, at) joined with ``stored`` (seed, item, place).

    Seeds with more than a ``HOT_SEEDS``-th of all hits, so fewer than ``HOT_SEEDS``,
    are dealt out over ``SALTS`` tasks each by their hits' keys.
    """
    counts = written(hits.groupBy("seed").agg(F.count(F.lit(1)).alias("n")), "seed_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("n") * HOT_SEEDS > total).select("seed", F.lit(True).alias("_hot")))
    left = hits.join(hot, "seed", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.col("key"), F.lit(SALTS))).otherwise(0).cast("int"))
    every = F.when(F.col("_hot"), F.array(*[F.lit(k) for k in range(SALTS)])).otherwise(F.array(F.lit(0)))
    right = stored.join(hot, "seed", "left").withColumn("_salt", F.explode(every))
    return left.drop("_hot").join(right.drop("_hot"), ["seed", "_salt"])


OVERLAPS = [f"{c} long" for c in ("key", "doc_id", "item_id", "n_equal", "item_words", "first_word", "end_word")]


def overlaps(near: DataFrame, pairs: DataFrame) -> DataFrame:
    """The overlaps (:data:`OVERLAPS`) of the documents ``near`` (key, doc_id, text)
    with the items of ``pairs`` (key, item_id, words, shifts).

    Each document's text is followed by its items, one row each, in sorted
    partitions, so a document of many items holds one of them at a time.
    """
    none = lambda kind: F.lit(None).cast(kind)
    texts = near.select("key", F.lit(0).alias("kind"), "doc_id", "text", none("long").alias("item_id"),
                        none("array<long>").alias("words"), none("array<long>").alias("shifts"))
    items = pairs.select("key", F.lit(1).alias("kind"), none("long").alias("doc_id"), none("string").alias("text"), "item_id",
                         "words", "shifts")
    rows = texts.unionByName(items).repartition("key").sortWithinPartitions("key", "kind")

    def compare(batches):
        owner, doc_id, doc = None, None, None
        for part in common.slices(batches, "text"):
            words, at = text_words(common.text_column(part, "text"))
            keys, kinds, ids, item_ids = (part.column(k).to_pylist() for k in (0, 1, 2, 4))
            out = []
            for k, key in enumerate(keys):
                if kinds[k] == 0:
                    owner, doc_id, doc = key, ids[k], words[at[k]: at[k + 1]]
                elif key == owner:
                    item = np.asarray(part.column(5)[k].values).view(np.uint64)
                    best = max(best_overlap(doc, item, s) for s in part.column(6)[k].as_py())
                    if best[0] >= min(LEAST_EQUAL, len(item)):
                        out.append((key, doc_id, item_ids[k], best[0], len(item), best[1], best[2]))
            if doc is not None:
                doc = doc.copy()  # not a view of the slice
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=[c.split()[0] for c in OVERLAPS])

    return rows.mapInArrow(compare, ", ".join(OVERLAPS))


def plain_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def row_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, doc_id, item_id, n_equal, item_words, first_word, end_word) of every row
    of ``docs`` and item that overlap; ``key`` is a hash of the row's id and text."""
    common.ship(docs.sparkSession)
    items = written(benchmark_items(benchmark), "seed_items")
    stored = written(item_seeds(items), "seeds")
    short = [r[0] for r in items.select(F.size("words")).where(F.size("words") < LEAST_EQUAL).distinct().collect()]
    near = written(suspects(plain_rows(docs), seed_bitmaps(stored), sorted(short)), "seed_suspects")
    hits = near.select("key", F.explode(F.arrays_zip("seeds", "places")).alias("_h"))
    hits = hits.select("key", F.col("_h.seeds").alias("seed"), F.col("_h.places").alias("at"))
    shifts = seed_pairs(hits, stored).select("key", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()
    shifts = written(shifts.groupBy("key", "item").agg(F.collect_list("shift").alias("shifts")), "seed_shifts")
    counts = shifts.groupBy("item").agg(F.count(F.lit(1)).alias("rows"))
    pairs = common.join_split(shifts, items, ["item"], counts, shifts.count())
    return overlaps(near.select("key", "doc_id", "text"), pairs)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_equal, item_words, first_word, end_word): the best
    overlap of each document and item that overlap.

    Null and empty texts on either side have no words and meet nothing; texts of any
    length are searched whole, with as many items as they hold; equal items count as
    one, with their smallest id; rows with the same doc_id give one row per item; a
    null doc_id is kept as null.  Other columns are not read.
    """
    best = row_overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_equal", "item_words", "first_word", "end_word")).alias("_b"))
    return best.select("doc_id", "item_id", "_b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose own text overlaps an item.

    Rows are told apart by id and text: of rows that share an id, or have none, only
    those with an overlap go, and rows equal in both go together.
    """
    own = docs.columns
    bad = written(row_overlaps(docs, benchmark).select(F.col("key").alias("_bad")).distinct(), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), row_key(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_key"))
    return rows.join(bad, rows["_key"] == bad["_bad"], "left_anti").select("_row.*")
