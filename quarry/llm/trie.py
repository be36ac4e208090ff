"""Prefix trie of conversations by whole-sequence collapse.

Turns are numbered by one range sort of their hashes and kept in blocks of
consecutive turns, so a conversation of any length is never gathered.  Every
conversation is rebuilt (it may open with turns of another one); identical ones
collapse into one sequence with a weight and the list of those that end there.
Sequences that are a proper prefix of another leave by anti-join; what stays are
the leaves.  The nodes of the trie are the distinct prefixes of the sequences,
with the weights of all sequences that pass added up.

What a subtree saves needs each of its nodes' words once.  So each node is owned
by one of the leaves that pass it, the one named by the smallest conversation.
The nodes that a leaf owns are the last ones on its way, so one number per leaf,
the words from the first of them on, tells what it adds to every node above.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.llm import common
from quarry.llm.common import written
from quarry.llm.quality import word_list

#: A conversation opens with up to HEADS - 1 turns of the one that its family
#: (FAMILY conversations in a row) is named after.
FAMILY = 20
HEADS = 4
#: Turns of a block, at most.
BLOCK = 4096

_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TURN = "struct<a:bigint,b:bigint,words:bigint>"


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the head of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


# Blocks of turns --------------------------------------------------------------

def hashed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, a, b, words): two hashes of role and text, and the text's words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"),
        F.size(word_list(text)).cast("long").alias("words"))


def turn_blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, start, turns): consecutive turns of a conversation, at most
    ``BLOCK``, from its turn number ``start`` (from 0) on."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    rows = written(hashed_turns(turns), "trie_turns").repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            ends = np.append(first[1:], len(conv))
            cuts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(first, ends)])
            at = pa.array(np.append(cuts, len(conv)).astype(np.int32))
            lists = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([batch.column(k) for k in (2, 3, 4)], ["a", "b", "words"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[cuts]), pa.array(np.full(len(cuts), part, np.int64)),
                 pa.array(np.arange(number, number + len(cuts))), lists], names=["conv_id", "part", "number", "turns"])
            number += len(cuts)

    found = written(rows.mapInArrow(blocks, f"conv_id long, part long, number long, turns array<{TURN}>"), "trie_blocks")
    # where blocks begin: from their sizes alone, one row per block
    before = Window.partitionBy("conv_id").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.select("conv_id", "part", "number", F.size("turns").alias("_k")).select(
        "conv_id", "part", "number", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("start"))
    return found.join(starts, ["conv_id", "part", "number"]).select("conv_id", "start", "turns")


def rebuilt_blocks(blocks: DataFrame) -> DataFrame:
    """(conv_id, start, turns) of the rebuilt conversations.  The first block of
    each stays even if it is empty."""
    zipped = blocks.where((F.col("conv_id") % FAMILY == 0) & (F.col("start") < HEADS - 1)).select(
        F.col("conv_id").alias("family"), "start", F.posexplode(F.slice("turns", 1, HEADS - 1)).alias("_at", "_turn"))
    heads = zipped.withColumn("_at", F.col("start") + F.col("_at")).where(F.col("_at") < HEADS - 1).groupBy("family").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_turn"))).alias("_head"))
    rows = blocks.withColumns({"_h": head_turns(F.col("conv_id")), "family": F.col("conv_id") - F.col("conv_id") % FAMILY})
    rows = rows.join(heads, "family", "left")
    taken = F.slice(F.coalesce(F.transform("_head", lambda t: t["_turn"]), F.array().cast(f"array<{TURN}>")), F.lit(1), F.col("_h"))
    rows = rows.withColumn("_taken", taken)
    own = F.slice("turns", F.greatest(F.col("_h") - F.col("start"), F.lit(0)).cast("int") + 1, F.size("turns"))
    opens = F.col("start") == 0
    rows = rows.select(
        "conv_id", F.when(opens, 0).otherwise(F.size("_taken") + F.greatest(F.col("start") - F.col("_h"), F.lit(0))).alias("start"),
        F.when(opens, F.concat("_taken", own)).otherwise(own).alias("turns"), opens.alias("_opens"))
    return rows.where(F.col("_opens") | (F.size("turns") > 0)).select("conv_id", "start", "turns", F.col("_opens").alias("opens"))


# Sequences ---------------------------------------------------------------------

HASHED = "conv_id long, start long, opens boolean, a array<long>, b array<long>, words array<long>"


def hashed_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the two prefix hashes within the block (``a``, ``b``):
    exclusive or of a hash of each turn and its place, so that the hash of a
    prefix is the or of its blocks'."""
    def hashes(batches):
        for batch in batches:
            lists = batch.column(2)
            at, turns = np.asarray(lists.offsets), lists.values
            at, turns = at - at[0], turns.slice(at[0], at[-1] - at[0])
            place = np.repeat(batch.column(1).to_numpy() - at[:-1], np.diff(at)) + np.arange(at[-1]) + 1
            place = place.astype(np.uint64)
            out = []
            for field, factor in ((0, _ONE), (1, _TWO)):
                h = turns.field(field).to_numpy().view(np.uint64)
                h = common.mixed(common.mixed(h + place * factor) ^ place)
                run = np.append(np.uint64(0), np.bitwise_xor.accumulate(h)) if len(h) else np.zeros(1, np.uint64)
                out.append((run[1:] ^ np.repeat(run[at[:-1]], np.diff(at))).view(np.int64))
            cuts = pa.array(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3),
                 *[pa.ListArray.from_arrays(cuts, pa.array(x)) for x in out],
                 pa.ListArray.from_arrays(cuts, turns.field(2))], names=[c.split()[0] for c in HASHED.split(", ")])

    return blocks.select("conv_id", "start", "turns", "opens").mapInArrow(hashes, HASHED)


def end_digests(convs: DataFrame) -> DataFrame:
    """(n, a, b, ends_sha256): SHA-256 of the ids of the conversations of each
    sequence, ascending, joined by commas.

    Ids are sorted over all tasks and joined into pieces there; the digest, which
    can only be taken from front to back, reads the pieces of a sequence one after
    another and holds none.
    """
    order = ["a", "b", "n", "conv_id"]
    rows = convs.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            if not keys.shape[1]:
                continue
            cuts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
            ids = batch.column(3).cast(pa.string()).to_pylist()
            text = [",".join(ids[i:j]) for i, j in zip(cuts, np.append(cuts[1:], len(ids)))]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[cuts]) for k in keys], pa.array(np.full(len(cuts), part, np.int64)),
                 pa.array(np.arange(number, number + len(cuts))), pa.array(text)], names=["a", "b", "n", "part", "number", "ids"])
            number += len(cuts)

    joined = rows.mapInArrow(pieces, "a long, b long, n long, part long, number long, ids string")
    joined = joined.repartition("a", "b", "n").sortWithinPartitions("a", "b", "n", "part", "number")

    def digests(batches):
        key, sha = None, None
        for batch in batches:
            done = []
            for a, b, n, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 5))):
                if (a, b, n) != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (a, b, n), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digest_rows(done)
        if key is not None:
            yield _digest_rows([(*key, sha.hexdigest())])

    return joined.mapInArrow(digests, "a long, b long, n long, ends_sha256 string")


def _digest_rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                                      names=["a", "b", "n", "ends_sha256"])


def sequences(blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sequences, their blocks, end digests) of hashed ``blocks``.

    A sequence (n, a, b, conv_id, weight) is named by its smallest conversation;
    its blocks (conv_id, weight, n, start, opens, a, b, words, before_a,
    before_b, after) know the hash of what lies before and the words after.
    """
    last = lambda c: F.coalesce(F.element_at(c, -1), F.lit(0))  # noqa: E731  # the block's whole hash
    some = F.size("a") > 0
    sizes = written(blocks.select(
        "conv_id", "start", F.size("a").cast("long").alias("k"), F.when(some, last("a")).otherwise(0).alias("a"),
        F.when(some, last("b")).otherwise(0).alias("b"), F.aggregate("words", F.lit(0).cast("long"), lambda s, x: s + x).alias("words")),
        "trie_sizes")
    convs = written(sizes.groupBy("conv_id").agg(F.sum("k").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")),
                    "trie_conversations")
    found = written(convs.groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight")),
                    "trie_sequences")
    named = found.select("conv_id", "weight", "n")
    # from the sizes alone, one row per block
    earlier = Window.partitionBy("conv_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    around = sizes.join(named, "conv_id").select(
        "conv_id", "start", "weight", "n", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in ("a", "b")],
        F.coalesce(F.sum("words").over(later), F.lit(0)).alias("after"))
    return found, written(blocks.join(around, ["conv_id", "start"]), "trie_sequence_blocks"), written(end_digests(convs), "trie_ends")


# Nodes --------------------------------------------------------------------------

STEPS = "a long, b long, parent_a long, parent_b long, depth long, words long, ends boolean"


def steps(blocks: DataFrame, *more: str) -> DataFrame:
    """One row per prefix of each sequence, the empty one included: its hashes
    and its parent's, depth, the words from its last turn on, whether the
    sequence ends there, and the columns ``more`` (long) of ``blocks``."""
    schema = ", ".join([STEPS, *[f"{c} long" for c in more]])

    def rows(batches):
        for batch in batches:
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            number = {c: col[c].to_numpy() for c in ("start", "n", "before_a", "before_b", "after")}
            for k in range(batch.num_rows):
                sums = np.asarray(col["words"][k].values, np.int64)
                rest = number["after"][k] + np.cumsum(sums[::-1])[::-1]
                depth = number["start"][k] + 1 + np.arange(len(sums))
                hashes = [np.append(number[f"before_{c}"][k], number[f"before_{c}"][k] ^ np.asarray(col[c][k].values, np.int64))
                          for c in ("a", "b")]
                out = [hashes[0][1:], hashes[1][1:], hashes[0][:-1], hashes[1][:-1], depth, rest]
                if col["opens"][k].as_py():  # the empty prefix
                    top = [0, 0, 0, 0, 0, rest[0] if len(rest) else number["after"][k]]
                    out = [np.append(x, y) for x, y in zip(top, out)]
                columns = [pa.array(x.astype(np.int64)) for x in out]
                columns.append(pa.array(out[4] == number["n"][k]))
                columns += [pa.array(np.full(len(out[0]), col[c][k].as_py(), np.int64)) for c in more]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    wanted = ["start", "n", "opens", "a", "b", "words", "before_a", "before_b", "after"]
    return blocks.select(*wanted, *more).mapInArrow(_merged(rows), schema)


def _merged(rows, least: int = 8192):
    """``rows`` with its small batches put together."""
    def merged(batches):
        held, size = [], 0
        for batch in rows(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= least:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


NODE = ["depth", "a", "b"]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations of ``turns`` (conv_id,
    turn, role, text): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (long) and ends_sha256.

    Turns are ordered by turn (null first), then by hash of role and text, so
    rows with the same turn have an order of their own and repeated rows stay as
    repeated turns.  Null roles and texts are empty.  Rows without a conv_id
    belong to no conversation and are left out.  The family of a negative id is
    found by the remainder with its sign.  Without conversations there is no
    node.  Turns are told apart by 128 bits of hash.  Other columns are not read.
    """
    spark = turns.sparkSession
    common.ship(spark)
    blocks = written(hashed_blocks(rebuilt_blocks(turn_blocks(turns))), "trie_rebuilt")
    found, blocks, ends = sequences(blocks)
    proper = steps(blocks).where("not ends").select(*NODE).distinct()
    leaves = found.withColumnRenamed("n", "depth").join(proper, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    blocks = written(blocks.join(leaves, "conv_id", "left").fillna(0, ["leaf"]).withColumnRenamed("conv_id", "seq"), "trie_leaf_blocks")

    leaf = F.when(F.col("leaf") == 1, F.col("seq"))
    nodes = steps(blocks, "seq", "weight", "leaf").groupBy(*NODE).agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("words")).alias("_all"), F.min(leaf).alias("_owner"), F.min_by("words", leaf).alias("_owned"),
        F.min("parent_a").alias("parent_a"), F.min("parent_b").alias("parent_b"))
    nodes = written(nodes, "trie_nodes")
    owned = nodes.groupBy(F.col("_owner").alias("seq")).agg(F.max("_owned").alias("owned"))
    once = steps(blocks.join(owned, "seq"), "owned").groupBy(*NODE).agg(F.sum(F.least("words", "owned")).alias("_once"))
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b"))
    children = written(below.agg(F.count(F.lit(1)).alias("n_children")), "trie_children")
    empty = hashlib.sha256(b"").hexdigest()
    full = nodes.join(once, NODE).join(children, NODE, "left").join(ends.withColumnRenamed("n", "depth"), NODE, "left").select(
        "conv_id", "depth", "parent_a", "parent_b", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("_all") - F.col("_once")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
    parents = nodes.select(F.col("depth").alias("_d"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"),
                           F.col("conv_id").alias("parent_conv_id"))
    counts = children.select(F.col("depth").alias("_d"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"),
                             F.col("n_children").alias("rows"))
    top = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    rest = common.join_split(full.where("depth > 0").withColumn("_d", F.col("depth") - 1), parents, ["_d", "parent_a", "parent_b"],
                             counts, nodes.count())
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return top.select(*columns).unionByName(rest.select(*columns))
