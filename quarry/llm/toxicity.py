"""Toxicity by subword bags: averaged character n-gram vectors under a softmax.

A word's bag holds its character n-grams (with marks for its ends) and the word
itself, hashed into ``BUCKETS``; the bag of ``WINDOW`` words in a row, each
different one counted once, is averaged, and two linear units with a softmax give
the probability of the window.  A text scores as its strongest window, wherever it
begins, so a long text doesn't thin out a few words, and neither junk that repeats
one word nor words put before a passage change its score.  Vectors and units are
trained jointly in numpy on a bounded sample of labelled rows, with decay; models of
two thirds of it tell by the other third which bias gives a precision like the
recall.  Since all is linear before the softmax, scoring needs one number per bucket.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIMENSIONS = 4
WINDOW = 96
#: Zero vectors that every word's average counts: words of few n-grams weigh less,
#: and n-grams of long words nearly as much as those of short ones.
BLANKS = 40
#: The sample: labelled rows of class 0 and 1 at most, and their characters in all.
SAMPLE_ROWS = (3000, 1500)
SAMPLE_CHARS = (24_000_000, 12_000_000)
FOLDS = 5
DECAY = 1e-4
#: Scale of the units' inputs (averages over bags are small).
SCALE = 10.0
#: Parts of the sample that settle the bias by turns.
PARTS = 3
_FACTORS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                       0xFF51AFD7ED558CCD)]
WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


@dataclass(frozen=True)
class Model:
    """Logit per bucket and a bias."""

    bucket_logits: np.ndarray
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """The logit of label 1 of each text's strongest window."""
        bags = Bags(texts)
        values = self.bucket_logits[bags.bucket].astype(np.float64)
        words = np.bincount(bags.word, values, bags.words) / (np.bincount(bags.word, minlength=bags.words) + BLANKS)
        _, best = strongest(np.where(repeated(bags.key, bags.first), 0.0, words), bags.first)
        return best + self.bias

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of label 1 for each text."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def repeated(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the word ``key`` stands within the ``WINDOW`` words before, too; the
    words of text k lie from ``first[k]`` to ``first[k + 1]``."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((key, text))  # stable: places ascend
    same = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1]) & (np.diff(order) < WINDOW)
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    return out


def strongest(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, average) of each text's window of the greatest sum; a shorter text
    is one window, filled up with zeros.  Running sums give all windows."""
    n, size = len(values), np.diff(first)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    start = np.arange(n)
    end = np.minimum(start + WINDOW, np.repeat(first[1:], size))
    whole = (end - start == WINDOW) | (start == np.repeat(first[:-1], size))
    window = np.where(whole, sums[end] - sums[:-1], -np.inf)
    best, at = np.zeros(len(size)), np.asarray(first[:-1]).copy()
    some = size > 0
    if n:
        best[some] = np.maximum.reduceat(window, first[:-1][some])
        hit = np.flatnonzero(window == np.repeat(best, size))
        text, one = np.unique(np.repeat(np.arange(len(size)), size)[hit], return_index=True)
        at[text] = hit[one]
    return at, best / WINDOW


class Bags:
    """The n-grams of texts: bucket and word of each, key of each word, and the words
    of text k from ``first[k]`` to ``first[k + 1]``.  Words are runs of letters and
    digits (ASCII) and of all other characters beyond ASCII, in lower case."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        joined = "\n" + "\n".join(lowered) + "\n" * (max(GRAMS) + 1)
        code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        letter = (code >= 0x80) | (code - 48 < 10) | (code - 97 < 26)
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        number = np.cumsum(first) - 1  # the word at or before each place
        self.words = int(number[-1]) + 1
        starts = np.flatnonzero(first)
        code = np.where(letter, code, 1).astype(np.uint64)
        n = len(code) - max(GRAMS)
        bucket, word = [], []
        inside = letter[1: n + 1].copy()  # characters between the first and the last are of one word
        h = code[:n] * _FACTORS[0] + code[1: n + 1] * _FACTORS[1]
        for size in range(3, max(GRAMS) + 1):
            h = h + code[size - 1: n + size - 1] * _FACTORS[size - 1]
            if size > 3:
                inside &= letter[size - 2: n + size - 2]
            if size in GRAMS:
                at = np.flatnonzero(inside)
                bucket.append(_bucket(h[at]))
                word.append(number[at + 1])
        # the words themselves, by the sum of a hash of each character and its place
        at = np.flatnonzero(letter)
        place = (at - starts[number[at]]).astype(np.uint64)
        parts = common.mixed(code[at] * _FACTORS[2] + place * _FACTORS[3])
        begins = np.flatnonzero(first[at])
        self.key = np.add.reduceat(parts, begins) if len(begins) else np.zeros(0, np.uint64)
        bucket.append(_bucket(self.key))
        word.append(np.arange(self.words))
        self.bucket, self.word = np.concatenate(bucket), np.concatenate(word)
        lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts))
        self.first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]) + 1)


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 17)).astype(np.int32)


class _Adam:
    """Adam steps."""

    def __init__(self, shape):
        self.m, self.v, self.t = np.zeros(shape), np.zeros(shape), 0

    def step(self, values, grad, rate):
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        values -= rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.99 ** self.t)) + 1e-8)


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + counts[0] - 1, first[1] .. and so on."""
    ends = np.cumsum(counts)
    return np.repeat(first - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def fit(texts: list[str], labels: list[int], seed: int = 7, steps: int = 60, warm: int = 15, rate: float = 0.1) -> Model:
    """Trains vectors and softmax together: the first ``warm`` steps on a random
    window of each text, then on each text's strongest, both classes weighing alike."""
    y = np.asarray(labels, np.int64)
    rng = np.random.RandomState(seed)
    # every different word once: its n-grams in gram[at[w]: at[w + 1]]
    numbers: dict[str, int] = {}
    said = [[numbers.setdefault(w, len(numbers)) for w in WORD.findall(t.lower())] for t in texts]
    word = np.concatenate([np.array(x, np.int64) for x in said])
    first = np.concatenate([[0], np.cumsum([len(x) for x in said])])
    if not len(word):
        return Model(np.zeros(BUCKETS, np.float32), -20.0)
    bags = Bags(list(numbers))
    order = np.argsort(bags.word, kind="stable")
    known, gram = np.unique(bags.bucket[order], return_inverse=True)  # buckets that the sample uses, renumbered
    grams = np.bincount(bags.word, minlength=len(numbers))
    at, of_word = np.concatenate([[0], np.cumsum(grams)]), np.repeat(np.arange(len(numbers)), grams)
    share = 1.0 / (grams + BLANKS)
    counted = ~repeated(word, first)
    vectors = rng.normal(0, 0.1, (len(known), DIMENSIONS))
    units, bias = rng.normal(0, 0.3, (DIMENSIONS, 2)), np.zeros(2)
    adams = [_Adam(x.shape) for x in (vectors, units, bias)]
    chosen = np.flatnonzero(np.diff(first))
    size = np.minimum(np.diff(first), WINDOW)[chosen]
    label = y[chosen]
    weight = 0.5 / np.maximum(1, np.bincount(label, minlength=2))[label]
    number = np.zeros(len(numbers), np.int64)  # of the words that a step uses
    for step in range(steps):
        if step < warm:
            begin = first[:-1][chosen] + (rng.rand(len(chosen)) * (np.diff(first)[chosen] - size + 1)).astype(np.int64)
        else:
            logit = np.bincount(of_word, (vectors @ (units[:, 1] - units[:, 0]))[gram], len(numbers)) * share
            begin = strongest(logit[word] * counted, first)[0][chosen]
        places = _spread(begin, size)
        window = np.repeat(np.arange(len(chosen)), size)[counted[places]]
        said_now = word[places[counted[places]]]
        used = np.zeros(len(numbers), bool)
        used[said_now] = True
        words = np.flatnonzero(used)
        number[words] = np.arange(len(words))
        slot = number[said_now]
        near = gram[_spread(at[words], grams[words])]
        near_word = np.repeat(np.arange(len(words)), grams[words])
        scale = share[words] * (SCALE / WINDOW)
        # averages as sums, one dimension at a time: n-grams to words, words to windows
        in_words = np.stack([np.bincount(near_word, vectors[near, d], len(words)) for d in range(DIMENSIONS)], 1) * scale[:, None]
        bag = np.stack([np.bincount(window, in_words[slot, d], len(chosen)) for d in range(DIMENSIONS)], 1)
        z = bag @ units + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(chosen)), label] -= 1
        p *= weight[:, None]
        back = p @ units.T
        to_words = np.stack([np.bincount(slot, back[window, d], len(words)) for d in range(DIMENSIONS)], 1) * scale[:, None]
        grad = np.stack([np.bincount(near, to_words[near_word, d], len(known)) for d in range(DIMENSIONS)], 1)
        speed = rate * min(1.0, 2 * (1 - step / steps))
        adams[0].step(vectors, grad + DECAY * vectors, speed)
        adams[1].step(units, bag.T @ p + DECAY * units, speed)
        adams[2].step(bias, p.sum(0), speed)
    logits = np.zeros(BUCKETS, np.float32)
    logits[known] = SCALE * (vectors @ (units[:, 1] - units[:, 0]))
    return Model(logits, float(bias[1] - bias[0]))


def even_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit from which on as many texts are taken for label 1 as have it, so that
    precision and recall are alike; the average of those next to it."""
    ordered, k = np.sort(logits)[::-1], int(labels.sum())
    near = max(1, k // 50)
    return float(ordered[max(0, k - near): k + near].mean())


def train(texts: list[str], labels: list[int], seed: int = 7, steps: int = 60, warm: int = 15) -> Model:
    """A model of all rows, with the bias that suits the logits that each row gets from
    a model of the others (``PARTS`` of them).  Without both labels the score is
    constant."""
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 20.0 if labels and labels[0] == 1 else -20.0)
    y = np.asarray(labels, np.int64)
    part = np.zeros(len(y), np.int64)
    for k in (0, 1):  # rows of either class by turns
        rows = np.flatnonzero(y == k)
        part[rows] = np.arange(len(rows)) % PARTS
    model = fit(texts, labels, seed, steps, warm)
    if min(np.bincount(y)) < PARTS:
        return model
    unseen = np.zeros(len(y))
    for k in range(PARTS):
        rest, left = np.flatnonzero(part != k), np.flatnonzero(part == k)
        other = fit([texts[i] for i in rest], y[rest].tolist(), seed, steps, warm)
        unseen[left] = other.logits([texts[i] for i in left])
    return Model(model.bucket_logits, model.bias - even_cut(unseen, y))


def held_out(doc_id: Column) -> Column:
    """Rows of the fold that is never learnt from (a null id is in none)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows_per_class: tuple[int, int] = SAMPLE_ROWS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows_per_class`` rows of each class, chosen by hash
    of the id among labelled rows outside the held-out fold.

    Rows of a class are drawn while their texts, whole and of any length, have no more
    than ``SAMPLE_CHARS`` characters together, so what reaches the driver has a fixed
    bound.  Ids with labels of both classes are left out.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_m")).where("toxic = _m")
    # twice as many ids as needed: some may be of missing texts
    some = [rows.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows_per_class[k]).select("doc_id", "toxic")
            for k in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    held = common.written(held, "toxicity_candidates")  # no more rows than ids drawn
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    sizes = held.select("doc_id", "toxic", F.row_number().over(order).alias("_n"), F.sum(F.length("text")).over(order).alias("_chars"))
    bound = lambda pair: F.when(F.col("toxic") == 0, pair[0]).otherwise(pair[1])
    drawn = sizes.where((F.col("_n") <= bound(rows_per_class)) & (F.col("_chars") <= bound(SAMPLE_CHARS))).select("doc_id")
    found = sorted(held.join(drawn, "doc_id", "left_semi").select("doc_id", "toxic", "text").collect())
    return [r["text"] for r in found], [r["toxic"] for r in found]


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    The score depends on the text alone; null and empty texts get the score of a
    window without words.  Repeated rows and null ids keep their rows; with no
    labelled rows, or one class only, all scores are equal.  Other columns are
    not read.
    """
    common.ship(docs.sparkSession)
    model = train(*training_sample(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scores(batches):
        for part in common.slices(batches, "text", 1 << 20):
            found = model.score(common.text_column(part, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "score"])

    scored = rows.mapInArrow(scores, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
