"""quarry: DataFrame operators and jobs for survey summaries, delimited event
reports, person/account candidate selection, keyed aggregates and message streams.

Every operator takes and returns DataFrames and stays lazy unless its docstring
says it materialises (a row index is written as parquet; table and file sinks write).
"""

__version__ = "0.1.0"
