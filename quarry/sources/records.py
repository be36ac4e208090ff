"""Positional records: persons and accounts, with an allowed-values check."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import jvm_trim, split_literal
from quarry.operators.accounts import ACCOUNT_TYPES
from quarry.sources.csv import positional_fields


def check_enum(c: Column | str, allowed: Sequence[str], what: str = "value") -> Column:
    """Pass the value through if it is one of ``allowed``; fail the job otherwise."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isin(*allowed), x).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(x, F.lit("null"))))
    )


def _lenient(lines: DataFrame, line_col: str, columns: dict[str, str], allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Typed columns by position, null where a field is missing, cannot be read
    or isn't allowed; ``reject`` holds the line if any is (null for good lines)."""
    parts = split_literal(line_col, ",")
    fields = {}
    for k, (name, kind) in enumerate(columns.items()):
        text = jvm_trim(F.get(parts, k))
        fields[name] = text if kind == "string" else text.try_cast(kind)
        if name in allowed:
            fields[name] = F.when(text.isin(*allowed[name]), text)
    out = lines.select(F.col(line_col).alias("_q_line"), *[c.alias(name) for name, c in fields.items()])
    bad = reduce(operator.or_, [F.col(c).isNull() for c in fields])
    return out.select(*fields, F.when(bad, F.coalesce("_q_line", F.lit(""))).alias("reject"))


def parse_persons(lines: DataFrame, line_col: str = "value", strict: bool = True) -> DataFrame:
    """``id, name, age, earnings`` lines -> typed persons; id and name are
    trimmed (every character <= U+0020).  A bad line fails the job; with
    ``strict=False`` it keeps what can be read and is in ``reject``."""
    if not strict:
        return _lenient(lines, line_col, {"id": "string", "name": "string", "age": "int", "earnings": "int"}, {})
    f = positional_fields(line_col, 4)
    return lines.select(
        jvm_trim(f[0]).alias("id"),
        jvm_trim(f[1]).alias("name"),
        jvm_trim(f[2]).cast("int").alias("age"),
        jvm_trim(f[3]).cast("int").alias("earnings"),
    )


def parse_accounts(lines: DataFrame, line_col: str = "value", strict: bool = True) -> DataFrame:
    """``id, person_id, type, balance`` lines -> typed accounts; the type
    must be a known account type.  A bad line fails the job; with
    ``strict=False`` it keeps what can be read and is in ``reject``."""
    if not strict:
        return _lenient(lines, line_col, {"id": "long", "person_id": "string", "type": "string", "balance": "int"},
                        {"type": ACCOUNT_TYPES})
    f = positional_fields(line_col, 4)
    return lines.select(
        jvm_trim(f[0]).cast("long").alias("id"),
        jvm_trim(f[1]).alias("person_id"),
        check_enum(jvm_trim(f[2]), ACCOUNT_TYPES, "account type").alias("type"),
        jvm_trim(f[3]).cast("int").alias("balance"),
    )
