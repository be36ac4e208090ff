"""Keyed aggregates: sums per key (combined and gathered), character
distributions and occurrence lists, lookups with a default, and metrics
collected alongside a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, DecimalType, IntegralType

from quarry.operators.partitioning import spread

def sum_by_key(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` per ``key`` with map-side combine (partial + final)."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def _sum_type(dt: DataType) -> str:
    """The type ``sum`` gives for a column type (long, wide decimal or double)."""
    if isinstance(dt, IntegralType):
        return "long"
    if isinstance(dt, DecimalType):
        return f"decimal({min(38, dt.precision + 10)},{dt.scale})"
    return "double"


def sum_by_key_gathered(
    df: DataFrame, key: str, value: str, name: str = "total", block: int = 100_000
) -> DataFrame:
    """Sum per key by first gathering the values into lists, then summing
    each list.

    Values are gathered per Arrow batch (cut into blocks of ``block`` rows)
    and key inside the scanning task (``mapInArrow``), so a list never holds
    more than a block, and only the list sums reach the shuffle.  Same result as :func:`sum_by_key` (sums of
    doubles may differ in the last bits); jobs use that one, which needs no
    pass through Python.
    """
    acc_type = _sum_type(df.schema[value].dataType)
    rows = df.select(F.col(key).alias("_q_key"), F.col(value).cast(acc_type).alias("_q_val"))
    key_type = df.schema[key].dataType.simpleString()

    def list_sums(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for first in range(0, batch.num_rows, block):
                part = pa.Table.from_batches([batch.slice(first, block)])
                lists = part.group_by("_q_key").aggregate([("_q_val", "list")])
                sums = [pc.sum(v.values).as_py() for v in lists.column("_q_val_list").combine_chunks()]
                yield pa.RecordBatch.from_arrays(
                    [lists.column("_q_key").combine_chunks(), pa.array(sums, batch.schema.field("_q_val").type)],
                    names=["_q_key", "_q_sum"])

    sums = rows.mapInArrow(list_sums, f"_q_key {key_type}, _q_sum {acc_type}")
    return sums.groupBy(F.col("_q_key").alias(key)).agg(F.sum("_q_sum").alias(name))


def characters(text: Column | str) -> Column:
    """Generator column: one row per character (code point) of ``text``;
    empty or null text gives no rows."""
    t = F.col(text) if isinstance(text, str) else text
    return F.explode(F.when(F.length(t) > 0, F.split(t, "")))


def char_distribution(df: DataFrame, text_col: str, name: str = "n") -> DataFrame:
    """Occurrences of each character over all texts: ``(ch, n)``.

    The characters are exploded and counted in the same stage, so only one
    partial count per distinct character and task reaches the shuffle.
    Few, large input partitions are spread over the cores first.
    """
    return (
        spread(df.select(text_col))
        .select(characters(text_col).alias("ch"))
        .groupBy("ch")
        .agg(F.count(F.lit(1)).alias(name))
    )


def char_occurrence_lists(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id, ch, ones``: for each text and character, the list holding a 1
    per occurrence (the gathered pairs of ``(character, 1)``).

    Occurrences are counted per text and character first (a partial
    aggregate in the exploding stage) and each list is built from its count
    (``array_repeat``), so single ones are never shuffled or buffered.
    Lists are per text, so a list is never longer than its text, however
    frequent the character is overall.
    """
    chars = spread(df.select(id_col, text_col)).select(id_col, characters(text_col).alias("ch"))
    counts = chars.groupBy(id_col, "ch").agg(F.count(F.lit(1)).alias("_q_n"))
    return counts.select(id_col, "ch", F.array_repeat(F.lit(1), F.col("_q_n").cast("int")).alias("ones"))


def char_occurrence_counts(lists: DataFrame, name: str = "n") -> DataFrame:
    """Total length of the occurrence lists per character (partial + final)."""
    return lists.groupBy("ch").agg(F.sum(F.size("ones")).cast("long").alias(name))


def char_totals(df: DataFrame, text_col: str) -> DataFrame:
    """Total number of characters (0 for none), and the same as the sum of a one
    for each, which per text is its length: no character becomes a row."""
    total = F.coalesce(F.sum(F.length(text_col).cast("long")), F.lit(0))
    return df.agg(total.alias("total_chars"), total.alias("total_chars_ones"))


def _map_side(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """``_q_lk, _q_lv``: one row per key.  A key that the lookup holds more than
    once fails the job when it runs, at any size; null keys match nothing and
    are left out."""
    counted = lookup.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_q_lk")).agg(
        F.count(F.lit(1)).alias("_q_c"), F.first(value).alias("_q_v"))
    repeated = F.raise_error(F.concat(F.lit("lookup keys are not unique: "), F.col("_q_lk").cast("string")))
    return counted.select("_q_lk", F.when(F.col("_q_c") > 1, repeated).otherwise(F.col("_q_v")).alias("_q_lv"))


def lookup_with_default(
    df: DataFrame,
    key: str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    default=0,
    name: str = "m",
    join_hint: str | None = None,
) -> DataFrame:
    """Append ``name`` = ``lookup[key]``, or ``default`` when the key is absent.

    ``lookup`` is a map: its keys must be unique, which is checked while the
    job runs by an aggregate over the lookup (no job runs here).  Spark picks
    the join by its size estimates, or by sizes measured at run time (AQE),
    under ``spark.sql.autoBroadcastJoinThreshold``; ``join_hint`` overrides it.
    """
    side = _map_side(lookup, lookup_key, lookup_value)
    side = side.hint(join_hint) if join_hint else side
    joined = df.join(side, df[key] == side["_q_lk"], "left")
    return joined.select(
        *[df[c] for c in df.columns], F.coalesce(F.col("_q_lv"), F.lit(default)).alias(name)
    )


def lookup_penalty(
    df: DataFrame,
    key: str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    min_key: int = 2,
    name: str = "total",
    join_hint: str | None = None,
) -> DataFrame:
    """With ``m = lookup[i]`` (default 0): keep ``i > min_key``, take
    ``(i - m) * m``, keep negative values and sum them per ``i`` (integral
    keys and values).

    The value of a row depends on its key alone, so rows are first counted
    per key (a partial aggregate, filter pushed below it); only the
    distinct keys meet the lookup, and each key's sum is its value times
    its row count.  A key holding a third of all rows never crosses the
    join as rows.
    """
    counts = (
        df.where(F.col(key) > F.lit(min_key))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_q_n"))
    )
    m = lookup_with_default(counts, key, lookup, lookup_key, lookup_value, 0, "_q_m", join_hint)
    found = F.col("_q_m").cast("long")
    value = (F.col(key).cast("long") - found) * found
    return m.where(value < 0).select(key, (value * F.col("_q_n")).alias(name))


def running_metrics(df: DataFrame, col: str) -> DataFrame:
    """Count, sum and average of a column in one pass (one row)."""
    return df.agg(
        F.count(col).alias("n"),
        F.sum(col).alias("total"),
        F.avg(col).alias("mean"),
    )


def write_with_metrics(df: DataFrame, col: str, path: str, fmt: str = "parquet") -> dict:
    """Write ``df`` and collect count / sum / average of ``col`` during the
    same job (``DataFrame.observe``), the accumulator pattern without a
    second pass.  Returns the metrics."""
    obs = Observation("quarry_metrics")
    observed = df.observe(
        obs, F.count(F.col(col)).alias("n"), F.sum(col).alias("total"), F.avg(col).alias("mean")
    )
    observed.write.format(fmt).mode("errorifexists").save(path)
    return obs.get


def observed_totals(query: StreamingQuery, name: str) -> dict:
    """The metrics of the observation ``name``, added up over the batches that the
    ended ``query`` has run (counts and sums; the progress of every batch must still
    be held, see ``spark.sql.streaming.numRecentProgressUpdates``)."""
    totals: dict = {}
    batches = [p for p in query.recentProgress if p.observedMetrics]
    if any(b.batchId > a.batchId + 1 for a, b in zip(batches, batches[1:])):
        raise RuntimeError("the progress of some batches is no longer held")
    last = {p.batchId: p.observedMetrics.get(name) for p in batches}
    for found in last.values():
        for metric, value in (found.asDict() if found is not None else {}).items():
            totals[metric] = totals.get(metric, 0) + (value or 0)
    return totals
