"""Column-level functions (all JVM-side expressions, no Python UDFs)."""

from quarry.functions.columns import bucket, classify_columns, row_sum
from quarry.functions.text import jvm_trim, split_literal

__all__ = ["bucket", "classify_columns", "row_sum", "jvm_trim", "split_literal"]
