from hypothesis import given, settings
from hypothesis import strategies as st
from quarry.llm import quality, queries

import brute
from conftest import DOCS, SF


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_query_against_plain_version(spark, sf_docs):
    got = {r.doc_id: r for r in queries.op2_quality_rules(spark, SF).collect()}
    assert len(got) == len(sf_docs)
    for doc_id, text, _ in sf_docs:
        assert base(got[doc_id]) == brute.base_quality(text)
        assert not (got[doc_id].kept and got[doc_id].base_failed)


def test_random_texts(spark):
    texts = []

    @settings(max_examples=150, deadline=None, database=None)
    @given(st.lists(st.sampled_from(["a", "b", "cc", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", "é", "#", "<", "\r"]), max_size=60))
    def collect(parts):
        texts.append("".join(parts))
        texts.append(" ".join(parts))

    collect()
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS).repartition(4)
    for r in quality.quality_rules(df).collect():
        assert base(r) == brute.base_quality(r.text), r.text


def test_odd_rows(odd_docs, no_docs):
    rows = quality.quality_rules(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert base(r) == brute.base_quality(r.text)
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 6} - {r.doc_id for r in rows if not r.kept}
    assert quality.quality_rules(no_docs).collect() == [] and quality.keep_good(no_docs).collect() == []


def test_rules_part_good_from_bad(spark):
    """Over the labelled test documents: nearly all good ones stay, nearly all bad ones go."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = queries.op2_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").select("quality", "base_failed", "kept").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_native(spark):
    plan = queries.op2_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "some words here", 1, 2, 3, 4, 5, "x")],
                               "doc_id long, text string, _in int, _own int, _text int, _words int, _Lines int, N_words string")
    row = quality.quality_rules(df).first()
    assert (row["_in"], row["_own"], row["_text"], row["_words"], row["_Lines"], row["n_words"]) == (1, 2, 3, 4, 5, 3)
    good = "the cat and the dog of the house are in the garden with a ball and that is all"
    kept = quality.keep_good(spark.createDataFrame([(1, good, 7, 8)], "doc_id long, text string, _row int, row int"))
    assert [tuple(r) for r in kept.collect()] == [(1, good, 7, 8)]
