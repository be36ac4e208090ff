"""Text helpers with the JVM's ``String.trim`` / ``String.split`` meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to U+0020 counts as blank for String.trim.
_BLANKS = "".join(chr(i) for i in range(0x21))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c: Column | str) -> Column:
    """Strip leading and trailing characters <= U+0020 (Spark's ``trim``
    strips spaces only)."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def split_literal(c: Column | str, delimiter: str) -> Column:
    """Split on a literal delimiter, dropping trailing empty parts.

    Matches ``String.split`` with a one-character delimiter: ``"a|b||"``
    gives ``[a, b]``, ``""`` gives ``[""]`` and ``"||"`` gives ``[]``.
    Spark's ``split`` takes a regex and keeps trailing empties, so the
    delimiter is quoted and trailing runs are removed first.
    """
    x = _col(c)
    quoted = "\\Q" + delimiter + "\\E"
    stripped = F.regexp_replace(x, f"(?:{quoted})+\\z", "")
    return (
        F.when(x == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, quoted))
    )
