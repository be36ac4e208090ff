import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and
    columns whose names the operators use inside."""
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen the end of it"
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " more", "en", None, None),
            (4, None, None, None, None), (5, "", "en", "b", 0), (None, "no id but some words here", "en", "b", 3),
            (None, None, None, None, None), (6, long_text, "en", "a", 9), (7, " \n\t ", "en", "b", 2),
            (8, "x", "en", "c", 1), (9, "the the the the the the the the the the the the", "en", "c", 1),
            (10, "é日本 ß \x1c\x85 😀 İstanbul KİLO", "xx", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({"n_words": F.lit("own"), "hash": F.lit(1), "kept": F.lit(None).cast("string"), "n": F.lit(2),
                           "_text": F.lit("own"), "sig": F.lit(0), "start": F.lit("s"), "row": F.lit(3)})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
