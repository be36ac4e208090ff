import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from quarry.llm import merkle, queries

SF = "/root/testdata/sf0.01"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def tree(nodes):
    """(root, siblings of each leaf with the place among them, level by level)."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % 3: p - p % 3 + 3]
            ways[i].append((run[: p % 3], run[p % 3 + 1:]))
            at[i] = p // 3
        level = [h(*level[k: k + 3]) for k in range(0, len(level), 3)]
    return level[0], ways


def brute(rows):
    """Rows of the query from tuples of FIELDS."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((leaf_of(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        sources[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees.append(tree([leaf for leaf, _ in sources[s]]))
    root, upper = tree([t[0] for t in trees]) if trees else ("", [])
    out = []
    for s, (subroot, ways), above in zip(names, trees, upper):
        for (leaf, r), way in zip(sources[s], ways):
            way = way + above
            node = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                node = leaf_of((*r[:4], r[4].replace("\n", "")))
            for left, right in way:
                node = h(*left, node, *right)
            out.append((r[0], leaf, subroot, root, h(*[x for left, right in way for x in left + right]), node, node == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*FIELDS).collect()]
    found = queries.op12_merkle_manifest(spark, SF)
    assert found.columns == COLUMNS
    found = result(found)
    assert found == brute(rows)
    assert 0 < sum(r[-1] for r in found) < len(found)


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_rounds(spark, monkeypatch, levels):
    """Small blocks, so that trees of all shapes take several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(100 * k + i, f"s{k}", "en", i, f"text\n{i % 3}") for k, n in enumerate([1, 2, 3, 4, 9, 10, 11, 27, 28, 30, 85])
            for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert result(merkle.merkle_manifest(df)) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    odd = odd_docs.withColumns({"tree": F.lit(3), "pos": F.lit("own"), "leaf": F.lit("own"), "block": F.lit(0.5), "upper": F.lit(None)})
    rows = [tuple(r) for r in odd.select(*FIELDS).collect()]
    assert result(merkle.merkle_manifest(odd)) == brute(rows)
    assert merkle.merkle_manifest(no_docs).collect() == []


def test_sources_and_lone_leaf(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for sources in ([None], ["a"], [None, "", "-", "z", "Z", "é", "s", "\U0001f600", "￿", " "]):
        rows = [(i, s, None, None, "a\nb") for i, s in enumerate(sources)]
        assert result(merkle.merkle_manifest(spark.createDataFrame(rows, schema))) == brute(rows)


def test_proof_proves(spark):
    """The proof as text folds from the leaf to the root, and other texts do not."""
    rows = [(i, "a", "en", i, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in merkle.merkle_manifest(df).collect():
        assert merkle.fold(r.leaf, r.proof, 0, r.doc_id, 100) == (r.root, len(r.proof))
        assert merkle.fold(h("other"), r.proof, 0, r.doc_id, 100)[0] != r.root
        assert h(r.proof) == r.proof_sha256 and r.verified
