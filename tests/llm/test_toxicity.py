import zlib

import numpy as np
import pytest
from quarry.llm import queries, toxicity

SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    rng = np.random.RandomState(3)
    plain = ["".join(rng.choice(list("aeioulmnrst"), rng.randint(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for i in range(400):
        w = list(rng.choice(plain, rng.randint(5, 200)))
        if i % 2:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randint(len(w)), "zquvk" + "".join(rng.choice(list("aeio"), 3)))
        texts.append(" ".join(w))
        labels.append(i % 2)
    return toxicity.train(texts, labels, steps=80, warm=30), plain


def test_unseen_misspellings(model):
    model, plain = model
    clean, bad = " ".join(plain[:100]), " ".join([*plain[:60], "Zquvkooo!", *plain[60:120]])
    scores = model.score([clean, bad, "zquvk", "zqquvki", ""])
    assert scores[0] < 0.5 and all(scores[1:4] > 0.5) and 0 <= scores[4] < 0.5


M64 = (1 << 64) - 1


def plain_bucket(h):
    return ((h * 0xBF58476D1CE4E5B9) & M64) >> 47


def plain_mixed(h):
    h ^= h >> 30
    h = (h * 0xBF58476D1CE4E5B9) & M64
    h ^= h >> 27
    h = (h * 0x94D049BB133111EB) & M64
    return h ^ (h >> 31)


def plain_word(model, word):
    """The average of a word's n-grams and of itself."""
    factors = [int(f) for f in toxicity._FACTORS]
    code = [1, *map(ord, word), 1]
    grams = [sum(c * f for c, f in zip(code[i:i + n], factors)) & M64 for n in (3, 4, 5) for i in range(len(code) - n + 1)]
    grams.append(sum(plain_mixed((ord(c) * factors[2] + i * factors[3]) & M64) for i, c in enumerate(word)) & M64)
    return sum(float(model.bucket_logits[plain_bucket(g)]) for g in grams) / (len(grams) + toxicity.BLANKS)


def plain_score(model, text):
    words = toxicity.WORD.findall(text.lower())
    values = [0.0 if w in words[max(0, i - toxicity.WINDOW + 1): i] else plain_word(model, w) for i, w in enumerate(words)]
    windows = [sum(values[i:i + toxicity.WINDOW]) for i in range(max(1, len(words) - toxicity.WINDOW + 1))]
    return 1 / (1 + np.exp(-(max(windows) / toxicity.WINDOW + model.bias)))


def test_score_equals_plain_averages(model):
    model, plain = model
    rng = np.random.RandomState(5)
    texts = ["One two, three", "é日本 x", " ".join(f"word{i}" for i in range(30)), "a", "...", "", "a a a a b a",
             " ".join(rng.choice(plain, 300)), " ".join(["zquvkoo", *rng.choice(plain[:9], 200), "zquvkoo zquvkoo"]), "Zquvk" * 50]
    assert model.score(texts) == pytest.approx([plain_score(model, t) for t in texts], abs=1e-6)
    assert [model.score([t])[0] for t in texts] == pytest.approx(model.score(texts).tolist())


def test_words_before_a_passage_change_nothing(model):
    model, plain = model
    bad = " ".join([*plain[:toxicity.WINDOW], "zquvkaie zquvkoei", *plain[-toxicity.WINDOW:]])
    scores = [model.score([" ".join([*["lala"] * k, bad])])[0] for k in range(9)]
    assert max(scores) - min(scores) < 1e-9


def test_repeating_a_word_adds_nothing(model):
    model, plain = model
    for w in ("zquvkoo", plain[0], plain[7]):
        assert model.logits([" ".join([w] * 60)])[0] == pytest.approx(model.logits([w])[0], abs=1e-9)


def test_sample_draws_long_texts_whole(spark, monkeypatch):
    texts = {1: "x " * 30_000, 2: "short", 3: "y " * 10, 4: None, 6: "z"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in texts], "doc_id long, quality int, toxic int")
    kept = {i: t or "" for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5}
    found, _ = toxicity.training_sample(docs, labels)
    assert sorted(found) == sorted(kept.values())
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", (10, 70_000))
    found, classes = toxicity.training_sample(docs, labels)
    assert sum(len(t) for t, c in zip(found, classes) if c == 0) <= 10 and sum(map(len, found)) <= 70_010


def test_held_out_accuracy(spark):
    rows = queries.op6_toxicity(spark, SF1).join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    found = sum(r.predicted and r.toxic for r in held)
    assert len(held) > 200 and sum(r.toxic for r in held) > 20
    assert found >= 0.9 * sum(r.toxic for r in held) and found >= 0.9 * sum(r.predicted for r in held)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 0, 1), (3, 0, 0), (6, 0, 1), (None, 0, 1), (9, 0, None)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    none = toxicity.score_toxicity(odd_docs, labels.where("false")).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.score_toxicity(no_docs, labels).collect() == []
