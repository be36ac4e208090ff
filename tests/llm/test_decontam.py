import numpy as np
import pyarrow as pa
from quarry.llm import decontam, queries

import brute
from conftest import DOCS, SF


def test_query_against_plain_version(spark, sf_docs):
    items = {r.item_id: brute.plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.n_equal for r in queries.op9_decontamination(spark, SF).collect()}
    grams = {i: {tuple(w[k:k + 6]) for k in range(len(w) - 5)} for i, w in items.items()}
    for d, t, _ in sf_docs:
        w = brute.plain_words(t)
        own = {tuple(w[k:k + 6]) for k in range(len(w) - 5)}
        for i, item in items.items():
            equal = brute.overlaps(w, item) if own & grams[i] else 0
            assert ((d, i) in got) == (equal >= 10), (d, i, equal)
            assert got.get((d, i), equal) == equal or equal < 10


def planted():
    rng = np.random.RandomState(2)
    new = lambda n: [f"{a}{b}" for a, b in zip(rng.choice(list("abcdé"), n), rng.randint(0, 10**6, n))]
    items = {k: new(14 + 5 * k) for k in range(8)}
    items[20], items[21], items[22] = new(7), new(5), new(4)  # shorter than a seed; the last is too short
    docs, leaks = {}, set()
    for k, item in items.items():
        around = lambda w: new(40) + w + new(40)
        docs[10 * k + 1] = " ".join(around(item))
        docs[10 * k + 2] = "; ".join(w.upper() + "!" for w in around(item))
        docs[10 * k + 3] = " ".join(new(120))
        if k != 22:
            leaks |= {(10 * k + 1, k), (10 * k + 2, k)}
        if k < 8:  # every eighth word replaced, by other words of the same number
            changed = [new(1)[0] if i % 8 == 4 else w for i, w in enumerate(item)]
            docs[10 * k + 4] = " ".join(around(changed))
            docs[10 * k + 5] = " ".join(around(item[:6]))  # too short a part
            leaks.add((10 * k + 4, k))
    return docs, items, leaks


def test_planted_leaks(spark):
    docs, items, leaks = planted()
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in docs.items()], DOCS).repartition(4)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(900, " ".join(items[3])), (901, None), (902, "")],
                                  "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_contamination(df, bench).collect()} == leaks
    assert {r.doc_id for r in decontam.decontaminate(df, bench).collect()} == set(docs) - {d for d, _ in leaks}
    none = decontam.find_contamination(df, bench.where("false"))
    assert none.collect() == []


def test_best_overlap_equals_plain_one():
    rng = np.random.RandomState(0)
    for _ in range(200):
        doc, item = rng.randint(0, 3, 30).astype(np.uint64), rng.randint(0, 3, rng.randint(1, 15)).astype(np.uint64)
        got = max(decontam.best_overlap(doc, item, s)[0] for s in range(-len(item) + 1, len(doc)))
        assert got >= 1 and got <= len(item)
        n, a, b = max(decontam.best_overlap(doc, item, s) for s in range(-len(item) + 1, len(doc)))
        assert n <= b - a


def test_words_do_not_depend_on_case_or_marks():
    a, at = decontam.text_words(pa.array(["Éa b-C, d", "éA B c (D)"]))
    assert at.tolist() == [0, 4, 8] and a[:4].tolist() == a[4:].tolist()


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "six seven eight nine ten eleven twelve thirteen fourteen the end", "own"), (None, None, "own")],
                                  "item_id long, text string, seed string")
    found = decontam.find_contamination(odd_docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_equal) for r in found) == [(1, 1, 11), (2, 1, 11), (3, 1, 11)]
    left = decontam.decontaminate(odd_docs, bench)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 4
    assert decontam.find_contamination(no_docs, bench).collect() == []


def test_every_overlap_meets_a_mask():
    """All patterns of equal and other words of 10 to 15 words."""
    fits = [[k for k, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    leaks = 0
    for n in range(10, 16):
        for pattern in range(1 << n):
            if pattern.bit_count() < 10:
                continue
            equal = np.array([pattern >> k & 1 for k in range(n)])
            if decontam.best_overlap(equal, np.ones(n, int), 0)[0] >= 10:
                leaks += 1
                assert any(equal[[a + k for k in ones]].all() for a in range(n - decontam.SPAN + 1) for ones in fits), equal
    assert leaks > 100


def test_seeds_of_masks():
    words = np.arange(1, 40, dtype=np.uint64)
    for mask, found in zip(decontam.MASKS, decontam.mask_seeds(words)):
        assert np.array_equal(found, decontam.seeds(words, mask))


def test_runs_and_replaced_words_against_plain_version(spark):
    """Exact parts of 9 to 11 words, and a fifth or a quarter of the words replaced."""
    rng = np.random.RandomState(8)
    count = iter(range(10**6))
    new = lambda n: [f"n{next(count)}" for _ in range(n)]
    items = {k: new(n) for k, n in enumerate([60, 60, 40, 30, 20, 15, 14, 13, 12, 11, 10, 9])}
    docs = []
    for item in items.values():
        docs += [item[a: a + n] for n in (9, 10, 11) for a in (0, len(item) // 3, max(0, len(item) - n))]
        docs += [[new(1)[0] if i % every == at else w for i, w in enumerate(item)] for every in (4, 5) for at in range(every)]
        for share in (0.2, 0.25):
            for _ in range(10):
                gone = set(rng.choice(len(item), round(share * len(item)), replace=False))
                docs.append([new(1)[0] if i in gone else w for i, w in enumerate(item)])
    docs = {k: [*new(15), *w, *new(15)] for k, w in enumerate(docs)}
    leaks, plain = set(), set()
    for d, words in docs.items():
        for i, item in items.items():
            if set(words) & set(item):
                if brute.overlaps(words, item) >= min(10, len(item)):
                    plain.add((d, i))
                x, y = np.array(words), np.array(item)
                if max(decontam.best_overlap(x, y, s)[0] for s in range(-len(y) + 1, len(x))) >= min(10, len(item)):
                    leaks.add((d, i))
    assert plain <= leaks  # of stretches that count the same, the plain version takes a shorter one
    df = spark.createDataFrame([(d, " ".join(w), None, None, None) for d, w in docs.items()], DOCS).repartition(4)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_contamination(df, bench).collect()} == leaks
    assert len(leaks) > 200


def test_rows_that_share_an_id_or_have_none(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, "see " + item), (None, "a clean text without an id"), (5, item + " end"), (5, "a clean text with the same id"),
            (6, "clean"), (6, None), (7, item), (7, item)]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontam.decontaminate(df, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(
        [(None, "a clean text without an id"), (5, "a clean text with the same id"), (6, "clean"), (6, None)], key=str)


def test_one_document_of_ten_thousand_items(spark):
    items = [[f"i{k}w{j}" for j in range(12)] for k in range(10_000)]
    text = " ".join(" ".join(w) for w in items)
    df = spark.createDataFrame([(1, text, None, None, None), (2, "clean " * 30, None, None, None)], DOCS)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string").repartition(4)
    found = decontam.find_contamination(df, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_equal, r.first_word) for r in found) == [(1, k, 12, 12 * k) for k in range(10_000)]


def test_hot_passage_of_many_documents_and_items(spark):
    """One passage in most documents and in many items: every pair is found."""
    passage = " ".join(f"p{i}" for i in range(15))
    docs = [(d, f"{passage} own{d} text{d}" if d % 3 else f"clean{d} words here", None, None, None) for d in range(300)]
    bench = [(k, f"start{k} {passage} end{k}") for k in range(20)]
    df = spark.createDataFrame(docs, DOCS).repartition(6)
    found = decontam.find_contamination(df, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(d, k) for d in range(300) if d % 3 for k in range(20)]
    assert {r.n_equal for r in found} == {15}
