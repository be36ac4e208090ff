import io
import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from quarry.llm import queries, tokens
from tokenizers import Tokenizer

from conftest import SF

PATH = queries.tokenizer_path()


def plain(texts):
    t = Tokenizer.from_file(PATH)  # as the library gives it
    return [x.ids for x in t.encode_batch(list(texts), add_special_tokens=False)]


ALPHABET = st.sampled_from(list("ab Zé日😀'\n\t\r\x0b\x1c\x85\xa0  　İß<|>09.,") + ["<|endoftext|>", "don't", "  ", "ñ ", " é"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), max_size=5))
def test_encoder_equals_the_library(texts):
    ids, counts = tokens.encoder(PATH)(pa.array(texts, pa.string()))
    expected = plain(texts)
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


END = "<|endoftext|>"


@settings(max_examples=100, deadline=None)
@given(st.lists(ALPHABET, max_size=20).map("".join), st.integers(0, 40), st.integers(1, 3))
def test_special_tokens_at_every_place(text, at, times):
    texts = [text[:at] + END * times + text[at:], END + text, text + END, f"{text} {END}", f"{text}\n\n{END} ", END[:-1] + text, END[3:]]
    ids, counts = tokens.encoder(PATH)(pa.array(texts, pa.string()))
    assert [ids[sum(counts[:k]): sum(counts[: k + 1])].tolist() for k in range(len(texts))] == plain(texts)


def test_special_token_ids():
    ids, _ = tokens.Encoder(PATH)(pa.array([f"a {END} b"]))
    assert ids.tolist() == [64, 220, 50256, 275]


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(tokens, "POOL_IDS", 10)
    encode = tokens.Encoder(PATH)
    for texts in (["some words here", "and more"], ["other words", "some words here"], ["and more"]):
        ids, _ = encode(pa.array(texts))
        assert ids.tolist() == [i for x in plain(texts) for i in x]


IN_A_WORKER = """
import os
import pyarrow as pa
from quarry.llm import common, queries, tokens

encode, threads = tokens.encoder(queries.tokenizer_path()), len(os.listdir("/proc/self/task"))
text = " ".join(f"w{k:x}" for k in range(200_000))
ids, counts = encode(pa.array([text, text[::-1]]))
assert len(ids) == counts.sum() > 400_000
print(len(os.listdir("/proc/self/task")) - threads, len(common._POWERS[0]))
"""


@pytest.mark.skipif(not os.path.isdir("/proc/self/task"), reason="threads can't be counted here")
def test_a_worker_encodes_in_one_thread_and_small_slices():
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": str(Path(tokens.__file__).parents[2])}
    out = subprocess.run([sys.executable, "-c", IN_A_WORKER], env=env, capture_output=True, text=True, check=True).stdout
    more_threads, longest = map(int, out.split())
    assert more_threads == 0 and longest <= (1 << 18) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_segment_random_access(values):
    ids = np.array(values, np.uint32)
    raw = b"xyz" + tokens.segment_bytes(ids, np.array([5]), np.array([True]), np.array([len(ids)]))
    segment = tokens.Segment(io.BytesIO(raw), 3)
    assert np.array_equal(segment.ids(), ids) and segment.end == len(raw)
    for i in range(0, len(ids), 1 + len(ids) // 25):
        assert segment.token(i) == ids[i]


def test_segment_rejects_damage():
    raw = bytearray(tokens.segment_bytes(np.arange(600, dtype=np.uint32), np.array([1]), np.array([True]), np.array([600])))
    raw[-30] ^= 1
    with pytest.raises(ValueError):
        tokens.Segment(io.BytesIO(bytes(raw))).ids()
    with pytest.raises(ValueError):
        tokens.Segment(io.BytesIO(bytes(raw[:50])))


def test_query_against_the_library(spark, sf_docs):
    got = {r.doc_id: r for r in queries.op1_token_ids(spark, SF).collect()}
    at = 0
    for (doc_id, _, _), ids in zip(sorted(sf_docs), plain(t or "" for _, t, _ in sorted(sf_docs))):
        ids = ids + [0]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(sf_docs)


def test_odd_rows_and_random_access(odd_docs):
    manifest = tokens.write_tokens(odd_docs, PATH, partitions=3)
    rows = sorted(tokens.read_tokens(manifest).collect(), key=lambda r: r.start)
    texts = {r.doc_id: r.text for r in odd_docs.where("doc_id is not null").collect()}
    assert [r.doc_id for r in rows][:2] == [None, None]
    assert [r.doc_id for r in rows][2:] == sorted([*texts, 2])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (1, 4, 5, 10):
        ids = plain([texts[doc_id] or ""])[0] + [0]
        assert by_id[doc_id].n_tokens == len(ids)
        assert [tokens.token_at(manifest, by_id[doc_id].start + k) for k in range(min(4, len(ids)))] == ids[:4]
    with pytest.raises(IndexError):
        tokens.token_at(manifest, rows[-1].start + rows[-1].n_tokens)


def test_no_rows(no_docs):
    assert tokens.read_tokens(tokens.write_tokens(no_docs, PATH)).collect() == []
