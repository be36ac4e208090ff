"""Ordering operators: sorted (partition, position) tags, contiguous row index,
position inside a group, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.session import scratch_path

_POS_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def sorted_tags(
    df: DataFrame, order_by: Sequence[str | Column] | None, path: str | None = None, unique: bool = False
) -> DataFrame:
    """``df`` in ``order_by`` order, written once as parquet under the shared
    folder, with ``_q_part`` (sorted partition) and ``_q_pos`` (0-based place
    inside it): the global order is ``(_q_part, _q_pos)``.

    The frame is range-partitioned and sorted; ties in ``order_by`` are
    broken by input partition and place among its rows sorted by all columns,
    which a repeated task finds again whatever the order its rows arrive in,
    so a heavily repeated key is still split over many partitions.  With
    ``unique`` the order columns have no ties and this step is left out.  With
    ``order_by=None`` the rows keep the frame's own order (partition by
    partition, as ``zipWithIndex`` numbers them) and nothing is shuffled.  Writing the tags cuts the lineage: a lost executor
    cannot renumber rows, and later steps depend only on stored values.

    Materialises: runs the sort and the write when called.
    """
    spark = df.sparkSession
    location = path or scratch_path(spark, "row-index")
    ordered = df
    if order_by is not None and unique:
        ordered = df.orderBy(*order_by)
    elif order_by is not None:
        named = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        placed = df.sortWithinPartitions(*named).withColumn("_q_in", F.monotonically_increasing_id())
        ordered = placed.orderBy(*order_by, "_q_in").drop("_q_in")
    ordered.withColumn("_q_mid", F.monotonically_increasing_id()).write.mode(
        "errorifexists"
    ).parquet(location)
    stored = spark.read.schema(
        StructType(df.schema.fields + [StructField("_q_mid", LongType(), False)])
    ).parquet(location)
    return stored.select(
        *df.columns,
        F.shiftright(F.col("_q_mid"), _POS_BITS).alias("_q_part"),
        F.col("_q_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_q_pos"),
    )


def with_row_index(
    df: DataFrame, order_by: Sequence[str | Column] | None, name: str = "row_index",
    path: str | None = None, unique: bool = False,
) -> DataFrame:
    """Append a contiguous 0-based index in the order of ``order_by``.

    Distributed: rows are sorted and tagged with (partition, position) by
    :func:`sorted_tags`.  Per-partition counts, read from the tag column
    only, give offsets (one row per partition, a size bounded by the
    partition count) that are broadcast back onto the rows.  No step moves
    all rows to one partition.  Pass ``unique`` for order columns without ties,
    which also give a reproducible index.  ``order_by=None``
    numbers the rows in the frame's current order without sorting (the
    frame is still written once, so the numbering cannot change).

    Materialises: runs the sort and the write when called.
    """
    cols = list(df.columns)
    tagged = sorted_tags(df, order_by, path, unique)
    counts = tagged.groupBy("_q_part").agg(F.count(F.lit(1)).alias("_q_n"))
    before = Window.orderBy("_q_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_q_part", F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_off")
    )
    return tagged.join(F.broadcast(offsets), "_q_part").select(
        *cols, (F.col("_q_off") + F.col("_q_pos")).alias(name)
    )


def position_in_group(
    df: DataFrame, group: str, order_by: Sequence[str | Column], name: str = "pos",
    path: str | None = None,
) -> DataFrame:
    """Append the 0-based place of each row inside its ``group``, in
    ``order_by`` order (the exploded form of a sorted list per group).

    Computed without gathering a group: rows are sorted by
    ``(group, *order_by)`` and tagged by :func:`sorted_tags`, so a group
    spans a run of sorted partitions.  Per (partition, group) a partial
    aggregate gives the first position and row count; a window over those
    small rows (one per partition the group touches) gives the rows the
    group has in earlier partitions.  The rows then join their
    (partition, group) base, a key that never holds more than one sorted
    partition, so a group with a third of all rows is spread over many tasks.
    """
    cols = list(df.columns)
    tagged = sorted_tags(df, [group, *order_by], path)
    runs = tagged.groupBy("_q_part", group).agg(
        F.min("_q_pos").alias("_q_first"), F.count(F.lit(1)).alias("_q_n")
    )
    earlier = Window.partitionBy(group).orderBy("_q_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select(
        F.col("_q_part").alias("_q_bpart"), F.col(group).alias("_q_bgroup"),
        (F.coalesce(F.sum("_q_n").over(earlier), F.lit(0)) - F.col("_q_first")).alias("_q_base"),
    )
    on = (F.col("_q_part") == F.col("_q_bpart")) & F.col(group).eqNullSafe(F.col("_q_bgroup"))
    return tagged.join(bases, on).select(
        *cols, (F.col("_q_pos") + F.col("_q_base")).alias(name)
    )


def top_k_by_key(df: DataFrame, key: str, k: int, ascending: bool = True) -> DataFrame:
    """The ``k`` rows with the smallest (or largest) keys, sorted.

    Planned as TakeOrderedAndProject: each task keeps its own top k and only
    those reach the final merge.
    """
    order = F.col(key).asc() if ascending else F.col(key).desc()
    return df.orderBy(order).limit(k)
