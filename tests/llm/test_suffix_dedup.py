import hashlib
import random

import frames
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from strataflow.llm import suffix_dedup as S


def brute(rows, depth=50):
    first = {}
    big = 1 << 70
    for i, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            w = b[p:p + depth]
            first[w] = min(first.get(w, big), big - 1 if i is None else i)
    out = []
    for i, t, *_ in rows:
        b, own = (t or "").encode(), big - 1 if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if first[b[p:p + depth]] < own:
                gone[p:p + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, frames.SCHEMA)
    return sorted((tuple(r) for r in S.suffix_dedup(df, **more).collect()), key=str)


def test_unique_ids(spark):
    rows = [tuple(r) for r in frames.unique_ids(spark).collect()]
    assert run(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = frames.rows() + [(2, "other text under a known id " * 4, None, None, None), (11, frames.words(200, 3), None, None, None)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("chunk", [200, 4 << 20])
def test_shared_passages(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    r = random.Random(4)
    passages = [frames.words(12, k) for k in range(8)] + ["ab" * 70, "q" * 90, "é日" * 30]
    rows = [(i * 7 % 101 - 20, "".join(r.choice(passages + [frames.words(4, 100 + i), " "]) for _ in range(r.randint(1, 9))), None, None, None) for i in range(60)]
    assert run(spark, rows, bucket_bytes=1500) == brute(rows)


def test_empty_and_kept_bytes(spark):
    assert S.suffix_dedup(frames.empty(spark)).count() == 0
    text = frames.words(40, 1)
    got = {r["doc_id"]: bytes(r["kept"]) for r in S.suffix_dedup(spark.createDataFrame([(1, text, "", "", 1), (2, "new start " + text, "", "", 1)], frames.SCHEMA), with_text=True).collect()}
    assert got == {1: text.encode(), 2: b"new start " if text[0] != " " else b"new start"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.text(alphabet="ab", min_size=40, max_size=90)), min_size=2, max_size=8, unique_by=lambda x: x[0]))
def test_ranges_of_one_bucket(docs):
    import numpy as np

    got = {i: bytearray(len(t)) for i, t in docs}
    keys, place, windows, text = [], [], [], b""
    for i, t in docs:
        if len(t) >= 50:
            keys.append(i), place.append(0), windows.append(len(t) - 49)
            text += t.encode()
    ids, low, high = S.repeated_ranges(np.array(keys, dtype=np.int64), np.array(place, dtype=np.int64), np.array(windows, dtype=np.int64), np.frombuffer(text, np.uint8), 50)
    for i, a, b in zip(ids, low, high, strict=True):
        got[int(i)][a:b] = b"\1" * (b - a)
    want = {r[0]: r[2] for r in brute(docs)}
    assert {i: sum(g) for i, g in got.items()} == want


@pytest.mark.parametrize("widths", [((38, 30, 25, 30), (30, 38, 25, 30)), ((24, 43, 30, 25, 34), (43, 24, 30, 25, 34))])
def test_permuted_separator_lines_are_not_equal_runs(widths):
    import numpy as np

    docs = [(i, "|" + "+".join("-" * n for n in w) + "+") for i, w in enumerate(widths)]
    got = [bytearray(len(t)) for _, t in docs]
    ids, low, high = S.repeated_ranges(np.arange(2), np.zeros(2, np.int64), np.array([len(t) - 49 for _, t in docs]), np.frombuffer("".join(t for _, t in docs).encode(), np.uint8), 50)
    for i, a, b in zip(ids, low, high, strict=True):
        got[int(i)][a:b] = b"\1" * (b - a)
    assert [sum(g) for g in got] == [r[2] for r in brute(docs)]


def reduced(monkeypatch, rows, merged=1 << 22, per_chunk=4 << 20):
    """Bytes that each document loses, and the windows that went to buckets and the most that one sort got."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    monkeypatch.setattr(S, "CHUNK", per_chunk)
    monkeypatch.setattr(S, "MERGED_WINDOWS", merged)
    sorted_windows, plain = [], S.repeated_ranges
    monkeypatch.setattr(S, "repeated_ranges", lambda keys, place, windows, *a: sorted_windows.append(int(windows.sum())) or plain(keys, place, windows, *a))
    classes = S.gram_classes([])
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["key", "text"])
    sent = sorted((r["bucket"], r["runs"]) for b in S._map_batches([batch], 50, 3, classes, 5) for r in b.to_pylist())
    travelled = 0
    for bucket, blob in sent:
        if bucket >= 0:
            data = zstandard.ZstdDecompressor().decompress(blob)
            n = int(np.frombuffer(data, np.int64, 1)[0])
            travelled += int(np.frombuffer(data, np.int64, 3 * n, 8)[2 * n:].sum())
    gone = {r[0]: bytearray(len(r[1].encode())) for r in rows}
    table = pa.RecordBatch.from_arrays([pa.array([b for b, _ in sent], pa.int64()), pa.array([x for _, x in sent], pa.binary())], names=["bucket", "runs"])
    for b in S._reduce_batches([table], 50, 5, 1, classes):
        for r in b.to_pylist():
            step, low, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["parcel"]), np.int64).reshape(3, -1)
            for k, a, n in zip(np.cumsum(step), low, size, strict=True):
                assert k % 5 == r["part"]
                gone[int(k)][a:a + n] = b"\1" * n
    return {k: sum(g) for k, g in gone.items()}, travelled, max(sorted_windows)


@pytest.mark.parametrize("per_chunk", [4 << 20, 4000])
def test_copies_are_combined_before_the_sort(monkeypatch, per_chunk):
    text = frames.words(80, 5)
    windows = len(text) - 49
    rows = [(900 - i, text) for i in range(300)] + [(1, text[50:300] + frames.words(9, 6)), (2, "q" * 300), (-4, frames.words(20, 7))]
    lost, travelled, most = reduced(monkeypatch, rows, 2000, per_chunk)
    assert lost == {r[0]: r[2] for r in brute(rows)}
    # one copy a chunk travels, and a sort gets one copy and what is read before runs are combined
    assert travelled < (windows + 800) * (1 if per_chunk > 4000 else 80)
    assert most < 2 * 2000 + windows


def test_repeated_rows_travel_once(monkeypatch):
    rows = [(7, frames.words(80, 5))] * 300
    lost, travelled, _ = reduced(monkeypatch, rows)
    assert lost == {7: 0} and travelled == len(rows[0][1]) - 49


def test_ids_of_any_size_order_and_number(spark):
    shared, other = frames.words(40, 61), frames.words(40, 62)
    big = (1 << 63) - 1
    rows = [(big, shared), (None, shared + " tail of a null"), (-big, other), (big, "x " + shared), (-5, shared + " low"), (None, other), (None, other), (-big, "y"), (big - 1, other + " z"), (7, "")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], frames.SCHEMA)
    got = sorted(((r["doc_id"], r["n_bytes"], r["kept"]) for r in S.suffix_dedup(df, with_text=True).collect()), key=str)
    rank = lambda i: (i is None, i or 0)
    want = []
    for i, t in rows:
        data = t.encode()
        gone = set()
        for p in range(len(data) - 49):
            if any(rank(j) < rank(i) and data[p:p + 50] in u.encode() for j, u in rows):
                gone |= set(range(p, p + 50))
        want.append((i, len(data), bytes(b for p, b in enumerate(data) if p not in gone)))
    assert got == sorted(want, key=str)
