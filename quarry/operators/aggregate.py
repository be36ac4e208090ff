"""Grouped averages in four interfaces: DataFrame, SQL text over a view,
schema-typed rows, and a custom (Arrow-batched) aggregate.

All forms aggregate partially before the shuffle, so a group that holds a
large share of the rows is combined map-side and never gathered in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


# Functions of this module run inside Python tasks (mapInArrow); ship them
# by value so executors do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def grouped_averages(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    digits: int | None = 1,
    name_format: str = "avg({})",
) -> DataFrame:
    """Average ``values`` per ``keys`` group, rounded to ``digits``, sorted by the keys.

    Result columns are the keys and ``name_format.format(value)`` per value
    (``avg(x)`` by default, the names Spark's ``GroupedData.avg`` gives).
    """
    aggs = []
    for v in values:
        a = F.avg(v)
        if digits is not None:
            a = F.round(a, digits)
        aggs.append(a.alias(name_format.format(v)))
    return df.groupBy(*keys).agg(*aggs).orderBy(*keys)


def grouped_averages_sql_text(
    view: str, keys: Sequence[str], values: Sequence[str], digits: int = 1,
    name_format: str = "avg({})",
) -> str:
    """SQL text equivalent to :func:`grouped_averages` over a registered view."""
    k = ", ".join(f"`{c}`" for c in keys)
    avgs = ", ".join(
        f"ROUND(AVG(`{v}`), {digits}) AS `{name_format.format(v)}`" for v in values
    )
    return f"SELECT {k}, {avgs} FROM {view} GROUP BY {k} ORDER BY {k}"


def grouped_averages_sql(
    spark: SparkSession,
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    view: str = "summed",
    digits: int = 1,
    name_format: str = "avg({})",
) -> DataFrame:
    """Register ``df`` as temp view ``view`` and run the SQL form."""
    df.createOrReplaceTempView(view)
    return spark.sql(grouped_averages_sql_text(view, keys, values, digits, name_format))


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Typed view of rows: match columns by name, cast and check types.

    PySpark has no typed Dataset; ``DataFrame.to`` reorders, projects and
    up-casts to the declared schema and fails on a missing column.
    """
    return df.to(schema)


def grouped_averages_typed(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], schema: StructType,
    digits: int = 1,
) -> DataFrame:
    """Averages that keep the input value names, returned in ``schema``."""
    out = grouped_averages(df, keys, values, digits=digits, name_format="{}")
    return to_schema(out, schema)


def _partial_sums(keys: list[str], values: list[str]):
    def run(batches):
        import pyarrow as pa

        wanted = [(v, how) for how in ("sum", "count") for v in values]
        for batch in batches:
            # Arrow skips nulls and keeps NaN, as Spark's avg does
            found = pa.Table.from_batches([batch]).group_by(keys).aggregate(wanted)
            columns = [found.column(k) for k in keys]
            columns += [found.column(f"{v}_{how}").cast(pa.float64()) for v, how in wanted]
            names = [*keys, *[f"{v}__{how[0] if how == 'sum' else 'n'}" for v, how in wanted]]
            yield from pa.table(columns, names=names).combine_chunks().to_batches()

    return run


def grouped_averages_custom(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], digits: int = 1,
    name_format: str = "{}",
) -> DataFrame:
    """Custom aggregate: per batch, Arrow computes partial ``(sum, count)``
    per group (the map-side combine); Spark then merges the partials with
    built-in sums and divides.  Memory per task is one batch, whatever the
    group sizes.  Nulls are skipped and NaN counts, as with ``avg``.
    """
    keys, values = list(keys), list(values)
    key_fields = [df.schema[k] for k in keys]
    part_schema = StructType(
        key_fields
        + [StructField(f"{v}__s", DoubleType()) for v in values]
        + [StructField(f"{v}__n", DoubleType()) for v in values]
    )
    partials = df.select(*keys, *[F.col(v).cast("double") for v in values]).mapInArrow(
        _partial_sums(keys, values), part_schema
    )
    merged = partials.groupBy(*keys).agg(
        *[F.sum(f"{v}__s").alias(f"{v}__s") for v in values],
        *[F.sum(f"{v}__n").alias(f"{v}__n") for v in values],
    )
    outs = []
    for v in values:
        mean = F.try_divide(F.col(f"{v}__s"), F.col(f"{v}__n"))
        outs.append(F.round(mean, digits).alias(name_format.format(v)))
    return merged.select(*keys, *outs).orderBy(*keys)

