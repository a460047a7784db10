import zlib

import frames
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from strataflow.llm import piece_transducer as P


@pytest.fixture(scope="module")
def plain():
    return sentencepiece.SentencePieceProcessor(model_file=P.default_model())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeiothinr g ▁\n\t日本😀éß01<s>.,'", max_size=40) | st.text(max_size=20))
def test_equals_the_library(text):
    m, plain = P.machine(P.default_model()), sentencepiece.SentencePieceProcessor(model_file=P.default_model())
    if "\x00" in text or any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    ids = plain.encode(text)
    assert m.encode(text) == ids and m.decode(ids) == plain.decode(ids)


def test_decoding_any_ids(plain):
    r, m = np.random.default_rng(3), P.machine(P.default_model())
    for _ in range(200):
        ids = [int(x) for x in r.integers(3, 400, 12)]
        assert m.decode(ids) == plain.decode(ids)


def test_unigram_weights_take_the_best_scored_path():
    m = P.Machine(P.default_model())
    m.kind, m.prefix, m.trie, m.score, m.text = P.UNIGRAM, False, {}, [], []
    pieces = {"a": -1.0, "b": -1.5, "ab": -2.2, "abc": -9.0, "c": -3.0, "bc": -3.5}
    for i, (p, s) in enumerate(pieces.items()):
        node = m.trie
        for c in p:
            node = node.setdefault(c, {})
        node[""] = i
        m.score.append(s)
        m.text.append(p)
    assert [m.text[i] for i in m.shortest_path("abc")] == ["a", "bc"]


def test_rows(spark, plain):
    got = P.encode(frames.plain(spark)).collect()
    want = frames.rows()
    assert len(got) == len(want)
    by_text = {(r[0], r[1]): plain.encode(r[1] or "") for r in want}
    for r, w in zip(sorted(got, key=lambda r: (str(r["doc_id"]), r["ids_crc32"])), range(len(got)), strict=True):
        options = [ids for (i, t), ids in by_text.items() if i == r["doc_id"] and r["ids"] == ids]
        assert options and r["n_ids"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    decoded = {r["doc_id"]: r["text"] for r in P.decode(P.encode(frames.unique_ids(spark))).collect()}
    assert all(decoded[r["doc_id"]] == (r["text"] or "").replace("▁", " ") for r in frames.unique_ids(spark).collect())


def test_forgetting_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(P, "KEPT", 5)
    monkeypatch.setattr(P, "KEPT_STRETCHES", 5)
    text = frames.words(300, 5)
    assert P.Machine(P.default_model()).encode(text) == plain.encode(text)


def test_empty(spark):
    assert P.encode(frames.empty(spark)).count() == 0 and P.encode(frames.clashing(spark), with_ids=False).count() == len(frames.rows())


def small_machine():
    pieces = {P.MARK: 0, P.MARK + "a": 1, "a": 2, "b": 3, "ab": 4, "abc": 5, "bc": 6, P.MARK + "ab": 7, "x" + "y": 8}
    weights = [2.0, 2.5, 1.0, 1.5, 2.2, 9.0, 3.5, 3.1, 0.5]
    return P.compose(P.normaliser(True), P.union(P.piece_trie(pieces, weights.__getitem__), P.byte_fallback(20.0))), pieces, weights


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=f"abcxy é{P.MARK}", max_size=9))
def test_composed_transducer_takes_the_least_path_of_all(text):
    machine, pieces, weights = small_machine()
    spell = lambda c: [100 + b for b in c.encode()]
    normal = P.MARK + text.replace(" ", P.MARK)
    best = [(0.0, ())] + [(float("inf"), ())] * len(normal)
    for i in range(len(normal)):
        options = [(p, weights[n], (n,)) for p, n in pieces.items() if normal.startswith(p, i)]
        if normal[i] not in pieces:
            options.append((normal[i], 20.0, tuple(spell(normal[i]))))
        for p, w, ids in options:
            if best[i][0] + w < best[i + len(p)][0]:
                best[i + len(p)] = (best[i][0] + w, best[i][1] + ids)
    weight, ids = P.shortest(machine, text, spell)
    assert abs(weight - best[-1][0]) < 1e-9
    by_id = {n: p for p, n in pieces.items()}
    back = b"".join(by_id[i].encode() if i < 100 else bytes([i - 100]) for i in ids).decode()
    assert back == normal


def test_model_is_one_composed_transducer():
    m = P.machine(P.default_model())
    root = {read for read, *_ in m.transducer.arcs[m.body()]}
    assert {" ", P.MARK, P.OTHER} <= root and m.trie[" "] == m.trie[P.MARK]
    assert m.transducer.arcs[0] and all(out in (P.EPSILON, P.MARK) or isinstance(out, (int, str)) for arcs in m.transducer.arcs[:50] for _, out, _, _ in arcs)
    node = m.trie
    for c in " the":
        node = node[c]
    assert m.text[node[""]] == P.MARK + "the"
