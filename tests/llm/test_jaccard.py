import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from quarry.llm import common, jaccard, queries

import brute
from conftest import DOCS, SF


def check(rows, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(texts) and got == brute.components(texts)


def test_query_against_plain_version(spark, sf_docs):
    check(queries.op7_ngram_jaccard(spark, SF).collect(), {d: t for d, t, _ in sf_docs})


def near_copies():
    """Copies, chains of edits, shared passages, and pairs just at the threshold."""
    rng = np.random.RandomState(5)
    new = lambda n: [f"{a}{b}" for a, b in zip(rng.choice(list("abcdef"), n), rng.randint(0, 10**6, n))]
    passage, texts = new(50), []
    for group in range(6):
        base = new(120)
        for k in range(25):
            w = list(base)
            for _ in range(k % 8):
                w[rng.randint(len(w))] = new(1)[0]
            texts.append(" ".join(w))
        chain = list(base)
        for k in range(12):  # neighbours are similar, the ends are not
            chain[8 * k: 8 * k + 4] = new(4)
            texts.append(" ".join(chain))
    for k in range(60):  # mostly the passage, but not similar enough
        texts.append(" ".join([*new(12 + k % 9), *passage, *new(5)]))
    for n in (7, 8, 11, 12, 19, 28, 35):  # 3 of 4 shingles and the like
        w = new(n)
        texts += [" ".join(w), " ".join([*w[:-1], new(1)[0]]), " ".join([*w, new(1)[0]]), " ".join(w[1:])]
    texts += ["A b C", "a B c", "a b", "a b c d e", "A B C D E f"]
    return dict(enumerate(texts))


def test_near_copies(spark):
    texts = near_copies()
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], DOCS).repartition(5)
    check(jaccard.jaccard_components(df).collect(), texts)


def test_without_stars_the_same(spark, monkeypatch):
    """The pairs of the last round alone find the same components."""
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    texts = near_copies()
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], DOCS).repartition(5)
    check(jaccard.jaccard_components(df).collect(), texts)


SETS = st.sets(st.integers(-10**6, 10**6), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(SETS, st.sets(st.integers(-10**6, 10**6), max_size=12), st.integers(0, 12))
def test_filters_lose_no_similar_pair(one, more, fewer):
    a = np.array(sorted(one), np.int64)
    b = np.array(sorted(set(sorted(one)[fewer:]) | more) or [1], np.int64)
    common_tokens = len(set(a.tolist()) & set(b.tolist()))
    assert jaccard.similar_sets(a, b) == (100 * common_tokens >= 75 * (len(a) + len(b) - common_tokens))


def test_shingles_equal_plain_ones():
    texts = ["A b  c\td e f", "a B c d E f", "a b c d", "A b c D", "a b c", "", " ", "x " * 40, "é Ä b c d\x1ce f", "e" * 9000]
    sets = jaccard.shingle_sets(*common.buffers_of(pa.array(texts)))
    plain = [brute.shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])
    small = common.WordHasher()(*common.buffers_of(pa.array(texts)), limit=7)
    assert np.array_equal(small[0], common.WordHasher()(*common.buffers_of(pa.array(texts)))[0])


def test_odd_rows(odd_docs, no_docs):
    rows = jaccard.jaccard_components(odd_docs).collect()
    got = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert len(rows) == odd_docs.count()
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10}
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    assert jaccard.jaccard_components(no_docs).collect() == []


def test_repeated_ids_and_rows(spark):
    """One id with a copied and an own text; classes that share the smallest id."""
    rng = np.random.RandomState(9)
    new = lambda n: [f"w{x}" for x in rng.randint(0, 10**9, n)]
    one, two, three, four = (new(60) for _ in range(4))
    near = lambda w: " ".join([*w[:-1], new(1)[0]])
    join = " ".join
    rows = [(1, join(one)), (5, join(one)), (5, join(two)), (9, near(two)), (3, join(three)), (3, join(four)), (7, near(three)),
            (8, near(four)), (8, join(new(30))), (8, ""), (1, join(one)), (None, near(one)), (None, join(new(20)))]
    df = spark.createDataFrame([(d, t, None, str(k), None) for k, (d, t) in enumerate(rows)], DOCS).repartition(4)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.jaccard_components(df).collect())
    assert got == sorted([(1, 1), (5, 1), (5, 5), (9, 5), (3, 3), (3, 3), (7, 3), (8, 3), (8, 8), (8, 8), (1, 1), (0, 1), (0, 0)])
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    sure = [rows[k] for k in (0, 2, 4, 5, 8, 9, 12)]
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == sorted((d or 0, t) for d, t in sure)


def test_no_prefix_is_kept_on_disk(spark, monkeypatch):
    """Only the sets of the classes that pass the first filter are written with their tokens."""
    kept = {}

    def noted(df, kind, *more):
        kept[kind] = df.dtypes
        return common.written(df, kind, *more)

    monkeypatch.setattr(jaccard, "written", noted)
    texts = near_copies()
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], DOCS).repartition(5)
    check(jaccard.jaccard_components(df).collect(), texts)
    assert "jaccard_alive" in kept and not [k for k, columns in kept.items() if any("array" in t for _, t in columns)]


def test_one_python_worker_a_task(spark):
    """The two Python functions of the sets lie in different stages, also if few sets live."""
    texts = {k: f"one two three four five six {k % 3} seven" for k in range(30)}
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in texts.items()], DOCS)
    living = jaccard.with_digests(docs).groupBy("sig", "n").agg(F.min("key").alias("row"))
    sets = jaccard.sets_of(docs, common.written(living, "test_living"))
    rows = sets.collect()
    assert sorted(r.n for r in rows) == [4, 4, 4] and len({r.rep for r in rows}) == 3
    assert all(len(r.set) == r.n for r in rows)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "BroadcastHashJoin" not in plan
