"""Computed columns: row-wise sums, labelled buckets, prefix classification."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold(terms: list[Column]) -> Column:
    if len(terms) == 1:
        return terms[0]
    half = (len(terms) + 1) // 2
    return _fold(terms[:half]) + _fold(terms[half:])


def row_sum(cols: Iterable[ColumnLike], scale: float | int | None = None) -> Column:
    """Sum a list of columns row by row, optionally divided by ``scale``.

    The columns are added as a balanced tree in the given order, whatever
    their number, which keeps the expression shallow (a chain of hundreds of
    additions overflows the analyzer's stack).  An empty list sums to
    ``0.0`` (a group with no member column contributes nothing).
    """
    terms = [_col(c) for c in cols]
    total = _fold(terms) if terms else F.lit(0.0)
    return total / F.lit(scale) if scale is not None else total


Rule = tuple[Callable[[Column], Column], str]


def bucket(c: ColumnLike, rules: Sequence[Rule], default: str) -> Column:
    """Label a value by the first rule whose predicate holds, else ``default``.

    ``rules`` is an ordered list of ``(predicate, label)`` where the predicate
    maps the input column to a boolean column.  A null input gives null
    rather than the default label.
    """
    x = _col(c)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for predicate, label in rules:
        out = out.when(predicate(x), F.lit(label))
    return out.otherwise(F.lit(default))


def classify_columns(
    names: Sequence[str], groups: Sequence[tuple[str, Sequence[str]]]
) -> dict[str, list[str]]:
    """Split column names into named groups by prefix; the first group that
    matches wins and names that match no group are left out.

    Works on the schema only (driver-side metadata, no data is read).
    Each list keeps the input (header) order.
    """
    out: dict[str, list[str]] = {g: [] for g, _ in groups}
    for name in names:
        for group, prefixes in groups:
            if name.startswith(tuple(prefixes)):
                out[group].append(name)
                break
    return out
