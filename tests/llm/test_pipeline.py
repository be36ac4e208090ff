import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from quarry.llm import queries
from quarry.llm.common import table, written
from tokenizers import Tokenizer

import brute
from conftest import SF


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    items = [brute.plain_words(r.text) for r in table(spark, SF, "benchmark").collect()]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    before = {r.doc_id: r for r in docs.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = written(stage(spark, docs, SF), "test_stage")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == table(spark, SF, "documents").columns
        kept = Counter(r.doc_id for r in after.collect())
        if number == 0:
            verdict = {r.doc_id: r.kept for r in queries.op2_quality_rules(spark, SF).collect()}
            assert kept == Counter(d for d in before if verdict[d])
        if number == 1:
            found = brute.components({d: r.text for d, r in before.items()})
            assert kept == Counter(d for d in before if found[d][1] == d)
        if number == 2:
            grams = {tuple(w[k:k + 6]) for w in items for k in range(len(w) - 5)}
            for d, r in before.items():
                w = brute.plain_words(r.text)
                met = any(tuple(w[k:k + 6]) in grams for k in range(len(w) - 5))
                assert kept[d] == (0 if met and any(brute.overlaps(w, i) >= 10 for i in items) else 1)
        if number == 3:
            sizes, taken = Counter(), Counter()
            for d, r in before.items():
                sizes[r.source] += len(brute.words(r.text))
                taken[r.source] += kept[d] * len(brute.words(r.text))
            for s, target in brute.targets(sizes).items():
                most = max(len(brute.words(r.text)) for r in before.values() if r.source == s)
                assert abs(taken[s] - target) <= most / 2 + 1e-6 and max(kept.values()) <= 2
            before_rows = kept
        if number == 4:
            encode = Tokenizer.from_file(queries.tokenizer_path())  # as the library gives it
            at = 0
            for r in sorted(after.collect(), key=lambda r: r.start):
                ids = encode.encode(before[r.doc_id].text or "", add_special_tokens=False).ids + [0]
                assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                at += r.n_tokens
            assert kept == before_rows
        else:
            before = {r.doc_id: r for r in after.collect()}
        docs = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_odd_and_empty_documents(spark, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = written(stage(spark, docs, SF), "test_stage")
            if number < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == frame.columns
        assert docs.count() == 0 or frame is odd_docs


def test_one_row_of_each_component(spark, odd_docs):
    kept = sorted(r.doc_id or 0 for r in corpus_pipeline.near_duplicates(spark, odd_docs.unionByName(odd_docs), SF).collect())
    # twice the rows without id and words; of all others one row, of 1 to 3 (near copies) only 1
    assert kept == [0, 0, 0, 1, 4, 5, 6, 7, 8, 9, 10]
