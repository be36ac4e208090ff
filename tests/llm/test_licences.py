import random
import re

import pytest
from quarry.llm import licences, queries
from quarry.llm.licences import BASE, NAMES, NOTICES, Template

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def words(text):
    return WORD.findall((text or "").translate(LOW))


def phrase_at(w, template):
    n = len(template.words)
    return [i for i in range(len(w) - n + 1) if w[i:i + n] == template.words]


def brute(text, phrases=NAMES):
    """The row of a text without notices: every phrase tried at every word."""
    w = words(text)
    found = [(i, t.label) for t in BASE for i in phrase_at(w, t)]
    labels = {label for _, label in found}
    more = labels | {t.label for t in phrases if phrase_at(w, t)}
    at = [i for i, _ in found]
    return (len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(more)),
            1.0 if more else 0.0)


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences.licence_digests(licences.scan_licences(df))
    assert rows.columns == COLUMNS
    return [tuple(r)[1:] for r in sorted(rows.collect())]


def test_all_documents(spark):
    rows = {r.doc_id: tuple(r)[1:] for r in queries.op13_license_scan(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert rows == {d: brute(t) for d, t in texts.items()}
    assert {"mit", "apache-2", "cc-by-nc", "gpl-3"} <= {r[5] for r in rows.values()}


def test_phrases_anywhere(spark):
    rng = random.Random(5)
    said = sorted({w for t in BASE + NAMES for w in t.words} | {"licence", "mi", "t", "mit2", "émit", "ünder"})
    texts = [" ".join(rng.choice(said) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    for t in BASE + NAMES:
        phrase = rng.choice([" ", "-", ", ", "\n", "/.", "\x7f"]).join(t.words)
        texts += [phrase, phrase.upper(), f"x {phrase} y {phrase}", f"é{phrase}", f"{phrase}é", f"{phrase} {phrase}", phrase[1:]]
    texts += ["CC BY-NC CC BY NC cc by cc by nc", "the the mit license under the MIT license", "cc by nc", "İ under the mİt license",
              "BSD 3 clause KLicense", "bsd 2-clause license K K k", "\x00under\x00the\x00mit\x00license\x00", "日本 cc by nc 😀"]
    assert run(spark, texts) == [brute(t) for t in texts]


def test_notices(spark):
    """Whole notices, with words put in and left out, and texts that only share words with them."""
    rng = random.Random(9)
    plain = [f"plain{i}" for i in range(400)]
    around = lambda t: " ".join(rng.sample(plain, 90)) + "\n" + t + "\n" + " ".join(rng.sample(plain, 90))
    texts = []
    for t in NOTICES:
        w = t.text.split()
        keys = [k.split() for k in t.keys]
        free = [i for i in range(2, len(w) - 2) if not any(x in words(w[i]) for k in keys for x in k)]
        left_out = [x for i, x in enumerate(w) if i not in free[:2]]
        put_in = w[:free[0]] + ["really", "truly"] + w[free[0]:] if free else w
        texts += [around(" ".join(x)) for x in (w, left_out, put_in, rng.sample(w, len(w)))] + [t.text, around(t.text.replace(" ", "\n * "))]
    rows = run(spark, [*texts, "x y z " + NOTICES[2].text])
    for n, t in enumerate(NOTICES):
        for k in (0, 1, 2, 4, 5):
            row = rows[6 * n + k]
            assert t.label in row[5].split(",") and 0.6 < row[6] <= 1, (t.label, k)
        assert t.label not in rows[6 * n + 3][5].split(",")
    assert rows[-1][1:6] == (1, 6, 6, "apache-2", "apache-2")


def test_key_phrases_are_mandatory(spark):
    text = NOTICES[0].text
    rows = run(spark, [text, text.replace("hereby", "surely"), text.replace("without restriction", "with restriction")])
    assert [r[5] for r in rows] == ["mit", "", ""]


def test_frequent_anchors(spark):
    """Where a phrase's words are in all files, any of them may be the anchor."""
    texts = ["license version apache 2 under the mit cc by nc " * 3] * 50 + ["apache license version 2", "Apache License Version 2 cc by nc"]
    assert run(spark, texts) == [brute(t) for t in texts]


def test_idf_counts_rows(spark):
    df = spark.createDataFrame([("apache x",), ("Apache apache",), (None,), ("",)], "text string")
    found = licences.inverse_frequency(df, ["apache", "mit"])
    assert found == pytest.approx({"apache": 0.5108256237659907, "mit": 1.6094379124341003})


def test_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    odd = odd_docs.withColumns({"_words": F.lit("own"), "_hits": F.lit(1), "places": F.lit("own"), "label": F.lit(2), "w": F.lit(0)})
    rows = sorted(tuple(r) for r in licences.licence_digests(licences.scan_licences(odd)).fillna(-1, ["doc_id", "first_word", "last_word"]).collect())
    want = sorted((-1 if r.doc_id is None else r.doc_id, *[-1 if x is None else x for x in brute(r.text)]) for r in odd.collect())
    assert rows == want
    assert licences.scan_licences(no_docs).collect() == []


def test_long_text_of_many_hits(spark):
    text = "license cc by nc public gnu " * 20_000 + NOTICES[4].text
    row = run(spark, [text])[0]
    assert row[1:5] == (20_000, 1, 6 * 19_999 + 1, "cc-by-nc") and row[5] == "cc-by-nc,gpl-3"


def test_own_templates(spark):
    df = spark.createDataFrame([(1, "all rights are kept by Acme")], "doc_id long, text string")
    places = licences.scan_licences(df, (Template("acme", "rights are kept"),), ()).first()["places"]
    assert [tuple(p) for p in places] == [("acme", 1, 4, True, 1.0)]
