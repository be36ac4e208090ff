from collections import Counter

import pytest
from pyspark.sql import functions as F
from quarry.llm import mixing, queries

import brute
from conftest import DOCS, SF


def check(rows, sources, texts):
    sizes = Counter({s: 0 for s in sources.values()})
    for d, s in sources.items():
        sizes[s] += len(brute.words(texts[d]))
    expected, taken, most = brute.targets(sizes), Counter(), Counter()
    for r in rows:
        s = sources[r.doc_id]
        assert r.size == len(brute.words(texts[r.doc_id])) and r.source_size == sizes[s]
        assert r.target == pytest.approx(expected[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= most[s] / 2 + 1e-6


def test_query_against_plain_version(spark, sf_docs):
    rows = queries.op3_mix_sources(spark, SF).collect()
    check(rows, {d: s for d, _, s in sf_docs}, {d: t for d, t, _ in sf_docs})
    assert sorted(rows) == sorted(queries.op3_mix_sources(spark, SF).collect())


def test_many_sources_null_source_and_hot_source(spark):
    rows = [(i, " ".join(["w"] * (i * 7919 % 23)), None, [None, "hot", "é", "z", "Z", f"s{i % 5}"][min(i % 9, 5)], None)
            for i in range(900)] + [(1000, None, None, "empty", None), (1001, "", None, "empty", None)]
    df = spark.createDataFrame(rows, DOCS)
    check(mixing.mix_sources(df).collect(), {r[0]: r[3] for r in rows}, {r[0]: r[1] for r in rows})


def test_mixed_rows_follow_the_plan(spark, odd_docs):
    taken = Counter((r.doc_id, r.text) for r in mixing.mixed_rows(odd_docs).collect())
    planned = Counter()
    for r in mixing.mix_sources(odd_docs).collect():
        planned[r.doc_id] += r.copies
    by_id = Counter()
    for (d, _), n in taken.items():
        by_id[d] += n
    assert by_id == +planned
    assert mixing.mixed_rows(odd_docs).columns == odd_docs.columns


def test_no_rows(no_docs):
    assert mixing.mix_sources(no_docs).collect() == [] and mixing.mixed_rows(no_docs).collect() == []


def test_thresholds_split_equal_leading_bits(spark):
    """Hashes that share all but their last bits are told apart by finer levels."""
    rows = [("a", 10, (7 << 40) + i) for i in range(100)]
    slim = spark.createDataFrame(rows, "source string, size long, hash long")
    cut = mixing.thresholds(slim, spark.createDataFrame([("a", 333.0)], "source string, budget double")).first()["threshold"]
    assert slim.where(F.col("hash") < cut).count() == 33


def test_native(spark):
    plan = queries.op3_mix_sources(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
