"""Merkle manifest of a dataset by butterfly exchange.

Each source's documents are the leaves of a tree with FANOUT nodes to a run; the
sources' roots are the leaves of one more tree.  Leaves are placed by one range
sort of their digests and packed into aligned blocks of FANOUT^LEVELS, whose
trees are folded where they lie.  Then the blocks of a source swap roots in
rounds, as in a butterfly: in round r a block meets those whose numbers differ
in the r-th digit only (at most FANOUT of them), notes the others' roots as the
next part of its proofs, and hashes all to the next ancestor itself.  After the
last round every block holds its whole upper proof and the root, and nothing is
handed down.  The sources' roots are swapped in the same way.

At the ragged right edge a block's partner may not exist though the node does:
the last block, which lies in that node, then stands in for it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.common import written
from quarry.operators.ordering import position_in_group, with_row_index

FANOUT = 3
#: Levels of a block's tree: blocks hold up to FANOUT^LEVELS leaves.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Leaves -----------------------------------------------------------------------

def encoded(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """The digest of a document: SHA-256 of its encoded fields, one after another."""
    return F.sha2(F.concat(*[encoded(fields[c]) for c in FIELDS]), 256)


def is_altered(doc_id: Column) -> Column:
    """Documents that the test of the manifest tampers with."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, found): the source's key, and the digests (binary) of
    each document as recorded and as found later, after line ends have gone from
    the altered ones (null: the same)."""
    fields = {c: F.col(c).cast("string" if c in ("source", "lang", "text") else "long") for c in FIELDS}
    later = {**fields, "text": F.replace(fields["text"], F.lit("\n"), F.lit(""))}
    changed = is_altered(fields["doc_id"]) & F.contains(fields["text"], F.lit("\n"))
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), fields["source"]), F.lit("-")).alias("tree"), fields["doc_id"].alias("doc_id"),
        F.unhex(leaf_hash(fields)).alias("leaf"), F.when(changed, F.unhex(leaf_hash(later))).alias("found"))


# Blocks -----------------------------------------------------------------------

def tree_levels(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The levels of a tree, from its leaves up: ``levels`` more (a run may be of
    one node), or as many as leave one node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        low = out[-1]
        out.append([_h("".join(low[k: k + FANOUT])) for k in range(0, len(low), FANOUT)])
    return out


def block_levels(block: int, nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of a block: a first block that is not full is its whole tree."""
    return tree_levels(nodes, levels if block else None)


BLOCKS = "tree string, block long, doc_ids array<long>, leaves array<binary>, found array<binary>, root string"


def leaf_blocks(placed: DataFrame) -> DataFrame:
    """One row per block of ``placed`` (tree, doc_id, leaf, found, pos), with its root."""
    rows = placed.select("tree", F.floor(F.col("pos") / FANOUT ** LEVELS).alias("block"), "pos", "doc_id", "leaf", "found")
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    levels = LEVELS

    def packed(key, parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids, leaf, found = (rows.column(k).combine_chunks() for k in (3, 4, 5))
        root = block_levels(key[1], [x.hex() for x in leaf.to_pylist()], levels)[-1][0]
        at = pa.array([0, len(ids)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), *[pa.ListArray.from_arrays(at, x) for x in (ids, leaf, found)],
             pa.array([root])], names=[c.split()[0] for c in BLOCKS.split(", ")])

    def pack(batches):
        key, held = None, []  # the block being gathered: at most FANOUT^LEVELS rows
        for batch in batches:
            tree, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            for k in range(len(tree) + 1):
                if k == len(tree) or (tree[k], block[k]) != key:
                    if k > first:
                        held.append(batch.slice(first, k - first))
                    if k < len(tree):
                        if held:
                            yield packed(key, held)
                        key, held, first = (tree[k], block[k]), [], k
        if held:
            yield packed(key, held)

    return rows.mapInArrow(pack, BLOCKS)


# Butterfly --------------------------------------------------------------------

def butterfly(nodes: DataFrame, kind: str) -> DataFrame:
    """(tree, pos, n, upper, root) of ``nodes`` (tree, pos, n, hash), ``n`` being
    the nodes of the tree: the siblings on the way up, level by level and left to
    right, and the tree's root.

    A round is one exchange of as many rows as there are nodes (twice as many at
    most, with stand-ins), in groups of FANOUT at most; its result is written.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    state = nodes.select("tree", "pos", "n", "hash", F.lit("").alias("upper"))
    width = 1
    while width < most:
        state = written(_swap(state, width), f"merkle_{kind}")
        width *= FANOUT
    return state.select("tree", "pos", "n", "upper", F.col("hash").alias("root"))


def _swap(state: DataFrame, width: int) -> DataFrame:
    """One round: nodes of ``width`` places meet the others of their run."""
    run = F.floor(F.col("pos") / (FANOUT * width))
    digit = (F.floor(F.col("pos") / width) % FANOUT).cast("int")
    inside = F.col("pos") % width
    members = state.where(F.col("n") > width).select(
        "tree", run.alias("run"), inside.alias("inside"), digit.alias("digit"), "hash", "pos", "n", "upper")
    stands_in = (F.col("pos") == F.col("n") - 1) & (F.col("digit") > 0) & (F.col("inside") < width - 1)
    guests = members.where(stands_in).select(
        "tree", "run", F.explode(F.sequence(F.col("inside") + 1, F.lit(width - 1).cast("long"))).alias("inside"), "digit", "hash",
        F.lit(None).cast("long").alias("pos"), "n", F.lit("").alias("upper"))
    met = members.unionByName(guests).groupBy("tree", "run", "inside").agg(
        F.array_sort(F.collect_list(F.struct("digit", "hash", "pos", "n", "upper"))).alias("_met"))
    ancestor = F.sha2(F.array_join(F.transform("_met", lambda x: x["hash"]), ""), 256)
    own = met.select("tree", "_met", ancestor.alias("hash"), F.explode(F.filter("_met", lambda x: x["pos"].isNotNull())).alias("_own"))
    others = F.array_join(F.transform(F.filter("_met", lambda x: x["digit"] != F.col("_own.digit")), lambda x: x["hash"]), "")
    swapped = own.select("tree", "_own.pos", "_own.n", "hash", F.concat(F.col("_own.upper"), others).alias("upper"))
    return swapped.unionByName(state.where(F.col("n") <= width))


# Proofs -----------------------------------------------------------------------

def fold(node: str, siblings: str, at: int, pos: int, n: int) -> tuple[str, int]:
    """(root, end): the root over ``node``, place ``pos`` of ``n``, with the
    siblings that stand in ``siblings`` from character ``at`` to ``end``."""
    while n > 1:
        first = pos - pos % FANOUT
        before, after = pos - first, min(FANOUT, n - first) - (pos - first) - 1
        left, right = at + 64 * before, at + 64 * (before + after)
        node = _h(siblings[at: left] + node + siblings[left: right])
        at, pos, n = right, pos // FANOUT, -(-n // FANOUT)
    return node, at


PROOFS = ("doc_id long, leaf string, subroot string, root string, proof string, proof_sha256 string, "
          "folded_root string, verified boolean")


def merkle_manifest(docs: DataFrame, with_proof: bool = True) -> DataFrame:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text): per row its
    leaf, its source's root, the root of all, its proof (siblings, level by level
    from the leaf to the root, left to right) and the proof's SHA-256; and the root
    folded from the document as found later (see :func:`leaves`) with that proof,
    and whether it is the root.

    Leaves of a source stand by doc_id (null first), then digest, so repeated ids
    have a fixed order and equal rows are leaves of their own.  A null source is a
    source, before all others; others are ordered by their UTF-8 bytes.  Null and
    empty fields differ.  Documents without an id are never altered.  An empty
    table has no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    common.ship(spark)
    digests = written(leaves(docs), "merkle_leaves")
    blocks = written(leaf_blocks(position_in_group(digests, "tree", ["doc_id", "leaf"], "pos")), "merkle_blocks")
    counts = written(blocks.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "merkle_trees")
    total = blocks.count()
    sized = common.join_split(blocks.select("tree", F.col("block").alias("pos"), F.col("root").alias("hash")), counts, ["tree"],
                              counts.select("tree", F.col("n").alias("rows")), total)
    upper = butterfly(written(sized, "merkle_roots"), "blocks")
    # "-", the key of a null source, comes before "s..."
    ranked = written(with_row_index(upper.where("pos = 0").select("tree", F.col("root").alias("hash")), ["tree"], "pos", unique=True),
                     "merkle_sources")
    n_sources = ranked.count()
    above = butterfly(ranked.select(F.lit("").alias("tree"), "pos", F.lit(n_sources).cast("long").alias("n"), "hash"), "sources")
    above = ranked.select("tree", "pos").join(above.drop("tree"), "pos").select(
        "tree", F.col("pos").alias("rank"), F.col("n").alias("n_sources"), F.col("upper").alias("last"), F.col("root").alias("top"))
    whole = common.join_split(upper, above, ["tree"], counts.select("tree", F.col("n").alias("rows")), total)
    rows = blocks.drop("root").join(whole.withColumnRenamed("pos", "block"), ["tree", "block"])
    wanted = ["block", "doc_ids", "leaves", "found", "n", "upper", "root", "rank", "n_sources", "last", "top"]
    proved = rows.select(*wanted).mapInArrow(_proofs(with_proof), PROOFS)
    return proved if with_proof else proved.drop("proof")


def _proofs(with_proof: bool):
    names = [c.split()[0] for c in PROOFS.split(", ")]
    n_levels = LEVELS

    def proofs(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
                ids = row["doc_ids"].values
                nodes = [x.hex() for x in row["leaves"].values.to_pylist()]
                found = [x and x.hex() for x in row["found"].values.to_pylist()]
                block, n, rank, n_sources = (row[c].as_py() for c in ("block", "n", "rank", "n_sources"))
                subroot, top = row["root"].as_py(), row["top"].as_py()
                above = row["upper"].as_py() + row["last"].as_py()
                levels = block_levels(block, nodes, n_levels)
                out = []
                for i, leaf in enumerate(nodes):
                    parts, node, place = [], found[i] or leaf, i
                    for level in levels[:-1]:
                        first = place - place % FANOUT
                        left, right = "".join(level[first: place]), "".join(level[place + 1: first + FANOUT])
                        parts += [left, right]
                        node, place = _h(left + node + right), place // FANOUT
                    node, at = fold(node, above, 0, block, n)
                    node, _ = fold(node, above, at, rank, n_sources)
                    proof = "".join(parts) + above
                    out.append((leaf, proof if with_proof else None, _h(proof), node, node == top))
                leaf, proof, digest, node, same = zip(*out)
                size = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(x, pa.string()) for x in (leaf, [subroot] * size, [top] * size, proof, digest, node)],
                     pa.array(np.array(same))], names=names)

    return proofs
