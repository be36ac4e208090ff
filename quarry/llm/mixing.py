"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash.  A source takes the documents whose hash lies
below a threshold; a second, lower threshold takes some of them once more (the
thresholds are nested).  A threshold is found without sorting: sizes are summed
by source and hash bucket, the bucket in which the running sum meets the budget
is split into finer buckets, and so on; all levels but the first read only
documents of boundary buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
LEVEL_BITS = 12
LEVELS = 5


def text_size(text: Column) -> Column:
    """Words (runs of characters other than space, 9 to 13) of a text."""
    return F.size(F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACES), "")).cast("long")


def hash60(*columns: Column) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << (LEVEL_BITS * LEVELS)) - 1))


def bucket(h: Column, level: int) -> Column:
    """The leading ``(level + 1) * LEVEL_BITS`` bits of a hash."""
    return F.shiftright(h, LEVEL_BITS * (LEVELS - 1 - level))


def source_targets(sizes: DataFrame, share: float = SHARE, weights=WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn.  The
    budget, ``share`` of all sizes, is dealt by weight; no target passes
    ``most`` times its source's size and what is over goes to the others by
    weight.  So a target is min(most * size, level * weight): sources are full
    in the order of most * size / weight, and the level follows from running
    sums.  One row per source passes through one task, no documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    out = sizes.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size").cast("double"))
    out = out.withColumn("_r", F.col("_cap") / F.col("_w"))
    upto = Window.orderBy("_r", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    out = out.withColumn("_budget", F.least(share * F.sum("source_size").over(everything).cast("double"),
                                            F.sum("_cap").over(everything)))
    out = out.withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
    out = out.withColumn("_rest", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
    # the level if all sources from this one on are open; the right one is the first not past its own cap
    out = out.withColumn("_level", F.col("_left") / F.col("_rest"))
    open_from = F.min(F.when(F.col("_level") <= F.col("_r"), F.struct("_r", "_level"))).over(everything)
    out = out.withColumn("_cut", open_from)
    target = F.when(F.col("_cut").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_cut")["_level"] * F.col("_w")))
    return out.select("source", "source_size", target.alias("target"))


def thresholds(slim: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` (source, budget) with ``threshold``: hashes below it hold
    sizes that sum to the budget as nearly as whole hashes can.

    Null sources form a source of their own.
    """
    state = budgets.select("source", F.col("budget").alias("_need"), F.lit(0).cast("long").alias("_prefix"),
                           F.lit(False).alias("_done"))
    for level in range(LEVELS):
        found = state.withColumnsRenamed({"source": "_s"})
        inside = slim.join(found, slim["source"].eqNullSafe(found["_s"]) & ~F.col("_done") & (
            (bucket(slim["hash"], level - 1) == F.col("_prefix")) if level else F.lit(True)))
        sums = (inside.groupBy("source", bucket(F.col("hash"), level).alias("_b"))
                .agg(F.sum("size").alias("_sum"), F.first("_need").alias("_need")))
        running = F.sum("_sum").over(Window.partitionBy("source").orderBy("_b"))
        sums = sums.withColumn("_end", running.cast("double"))
        cut = sums.where(F.col("_end") > F.col("_need"))
        cut = cut.groupBy("source").agg(F.min(F.struct("_b", "_end", "_sum")).alias("_c"))
        cut = cut.select(F.col("source").alias("_s"), F.col("_c._b").alias("_b"),
                         (F.col("_c._end") - F.col("_c._sum")).alias("_before"), F.col("_c._sum").alias("_size"))
        joined = state.join(cut, state["source"].eqNullSafe(cut["_s"]), "left")
        # no boundary bucket: everything under this prefix is taken
        past = F.when(F.col("_prefix") >= 0, F.col("_prefix") + 1) if level else F.lit(1 << LEVEL_BITS)
        shift = LEVEL_BITS if level else 0
        prefix = F.when(F.col("_done"), F.shiftleft("_prefix", LEVEL_BITS)).otherwise(
            F.coalesce(F.col("_b"), F.shiftleft(past, shift) if level else past))
        need = F.col("_need") - F.coalesce("_before", F.lit(0.0))
        if level == LEVELS - 1:  # one hash (or equal ones) is left: the nearer side
            prefix = F.when(F.col("_b").isNotNull() & (2 * need >= F.col("_size")), F.col("_b") + 1).otherwise(prefix)
        state = joined.select("source", need.alias("_need"), prefix.cast("long").alias("_prefix"),
                              (F.col("_done") | F.col("_b").isNull()).alias("_done"))
        state = written(state, "mix_level")
    return state.select("source", F.col("_prefix").alias("threshold"))


def mix_sources(docs: DataFrame, share: float = SHARE, weights=WEIGHTS) -> DataFrame:
    """doc_id, source, size, hash, source_size, target, copies and taken per
    document of ``docs`` (doc_id, text, source).

    The hash is that of doc_id and text, so reruns agree and rows equal in both
    are taken alike.  A null or empty text has size 0; a null source is a source
    of its own and comes last; sources without words have target 0; an empty
    table gives no rows.  Each source's taken words miss its target by at most
    half the size of one boundary document (or of equal rows).
    """
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), text_size(F.col("text")).alias("size"),
                       document_hash().alias("hash"))
    return mix_sized(written(slim, "mix_sizes"), share, weights)


def document_hash() -> Column:
    return hash60(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def mixed_rows(docs: DataFrame, share: float = SHARE, weights=WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Only the thresholds (a row per source) are joined to the texts.
    """
    own = docs.columns
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), text_size(F.col("text")).alias("size"),
                       document_hash().alias("hash"))
    plan = mix_plan(written(slim, "mix_sizes"), share, weights)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col("source").cast("string").alias("_source"),
                       document_hash().alias("hash"))
    taken = rows.join(plan, rows["_source"].eqNullSafe(plan["_s"]))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), copies())).alias("_n")).select("row.*")


def mix_plan(slim: DataFrame, share: float, weights) -> DataFrame:
    """(_s, source_size, target, _base, threshold) per source."""
    targets = written(source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights),
                      "mix_targets")
    whole = F.col("target") > F.col("source_size")
    budgets = targets.select("source", (F.col("target") - F.when(whole, F.col("source_size")).otherwise(0)).alias("budget"))
    cuts = thresholds(slim, budgets).withColumnRenamed("source", "_c")
    return written(targets.join(cuts, targets["source"].eqNullSafe(cuts["_c"]), "left").select(
        F.col("source").alias("_s"), "source_size", "target", whole.cast("int").alias("_base"), "threshold"), "mix_plan")


def copies() -> Column:
    return F.col("_base") + (F.col("hash") < F.col("threshold")).cast("int")


def mix_sized(slim: DataFrame, share: float = SHARE, weights=WEIGHTS) -> DataFrame:
    """The mix of documents with known ``size`` and ``hash`` (60 bits)."""
    plan = mix_plan(slim, share, weights)
    out = slim.join(plan, slim["source"].eqNullSafe(plan["_s"]))
    return out.select("doc_id", "source", "size", "hash", "source_size", "target", copies().alias("copies"),
                      (F.col("size") * copies()).alias("taken"))
