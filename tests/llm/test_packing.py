import zlib

import frames
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from strataflow.llm import packing as K
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab cd\n\t  é日<|endoftext|>'s12.,  ", max_size=60))
def test_ids_equal_the_tokenizer(text):
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    assert K.token_ids(text, K.default_vocabulary()).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def check(rows, docs, tokenizer, window):
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    total = 0
    for d in docs:
        ids = [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        own = {r["start"]: r for r in pieces[d[0], len(ids)] if r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())}
        at = 0
        while at < len(ids):
            at += own[at]["length"]
        assert at == len(ids)
    assert total == sum(r["length"] for r in rows)
    return 1 - total / (window * len(sequences))


def test_awkward_rows(spark, tokenizer):
    rows = K.pack(frames.clashing(spark)).collect()
    check(rows, frames.rows(), tokenizer, K.WINDOW)


def test_little_padding(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_BUCKET", 16)
    docs = [(i, frames.words(20 + i * 37 % 900, i), None, None, None) for i in range(250)]
    assert check(K.pack(spark.createDataFrame(docs, frames.SCHEMA)).collect(), docs, tokenizer, K.WINDOW) < 0.05


def test_ids_are_returned(spark):
    r = K.pack(spark.createDataFrame([(1, "hello world", "", "", 1)], frames.SCHEMA), with_ids=True).collect()[0]
    assert r["ids"][-1] == 1 and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_empty(spark):
    assert K.pack(frames.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(0, 300), max_size=16))
def test_plan_uses_each_piece_once(histogram):
    used = {}
    for combo, repeats in K.plan(histogram, 16):
        assert sum(combo) <= 16 and repeats > 0
        for c in combo:
            used[c] = used.get(c, 0) + repeats
    assert used == {c: n for c, n in histogram.items() if n}
    runs = K.placements(K.plan(histogram, 16))
    for c, n in used.items():
        own = sorted(r[1:3] for r in runs if r[0] == c)
        assert [a for a, _ in own] == [0, *[b for _, b in own[:-1]]] and own[-1][1] == n


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_nnls_is_optimal(seed):
    r = np.random.default_rng(seed)
    a, b = r.random((6, 9)), r.random(6)
    x = K.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gradient <= 1e-6).all() and (np.abs(gradient[x > 1e-9]) <= 1e-6).all()


def test_strategies():
    assert sorted(K.strategies(4, 3)) == [(2, 1, 1), (2, 2), (3, 1), (4,)]


SPECIAL = "<|endoftext|>"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([SPECIAL, "<|endoftext", "|>", " ", "\n\n", "word", "é日", "12", "'s", " " * 999, " " * 1000, "\n" * 1001, "k" * 700]), max_size=9))
def test_ids_equal_the_tokenizer_with_default_settings(parts):
    import public_tokenizers

    global DEFAULT
    DEFAULT = globals().get("DEFAULT") or Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "".join(parts)
    ids = K.token_ids(text, K.default_vocabulary()).tolist()
    assert ids == [*DEFAULT.encode(text, add_special_tokens=False).ids, 1]
    assert ids.count(50256) == text.count(SPECIAL)


@pytest.mark.parametrize("run", [" ", "\n"])
def test_a_million_blanks_are_encoded(run):
    import public_tokenizers

    text = "before" + run * 1_000_000 + "after"
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert K.token_ids(text, K.default_vocabulary()).tolist() == [*want, 1]
