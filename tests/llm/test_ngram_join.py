import random
import re

import frames
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from strataflow.llm import ngram_join as N
from strataflow.llm import set_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for i, r in enumerate(rows):
        ids = [x[0] for x, g in zip(rows, group, strict=True) if g == group[i] and x[0] is not None]
        out.append((r[0], len(sets[i]), r[0] if not sets[i] else min(ids) if ids else None))
    return sorted(out, key=str)


def run(spark, rows, **more):
    return sorted((tuple(r) for r in N.jaccard_groups(spark.createDataFrame(rows, frames.SCHEMA), **more).collect()), key=str)


def test_awkward_rows(spark):
    assert run(spark, frames.rows()) == brute(frames.rows())


def near_copies():
    r, rows = random.Random(8), []
    for family in range(12):
        size = r.choice([4, 5, 6, 9, 20, 60, 150, 300])
        first = frames.words(size + 4, family).split()
        for _ in range(r.randint(2, 7)):
            w = list(first)
            for _ in range(r.randint(0, max(1, size // 25))):
                w[r.randrange(len(w))] = f"edit{r.randrange(999)}"
            rows.append((len(rows), " ".join(w[:r.randint(max(1, len(w) - size // 6), len(w))]), None, None, None))
    shared = frames.words(40, 77)
    rows += [(len(rows) + i, shared + " " + frames.words(r.randint(5, 60), 200 + i), None, None, None) for i in range(40)]
    return rows


@pytest.mark.parametrize("block", [4, 1024])
def test_near_copies_and_a_shared_passage(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = near_copies()
    assert run(spark, rows, bucket_bytes=2000) == brute(rows)


def test_all_subsets_of_larger_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "N2", 3)
    at, value = N.shingle_sets([r[1].encode() for r in near_copies()])
    _, size = N.set_ids(at, value, len(near_copies()))
    found = shared_pairs(at, value, size)
    for i, j in linked_pairs([r[1] for r in near_copies()]):
        assert (i, j) in found


def linked_pairs(texts):
    sets = [shingles(t) for t in texts]
    return [(j, i) for i in range(len(sets)) for j in range(i) if sets[i] and sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]


def shared_pairs(at, value, size, common=None):
    holders = {}
    for sig, doc in N.signatures(at, value, size, np.zeros(1 << 6, bool) if common is None else common):
        for s, d in zip(sig.tolist(), doc.tolist(), strict=True):
            holders.setdefault(s, set()).add(d)
    return {(a, b) for h in holders.values() for a in h for b in h if a < b}


@settings(max_examples=60, deadline=None)
@given(st.integers(4, 120), st.integers(0, 2**32), st.booleans())
def test_linked_sets_share_a_signature(n, seed, odd):
    r = np.random.default_rng(seed)
    one = r.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
    sets = [one]
    for _ in range(6):
        drop = int(r.integers(0, n // 5 + 1))
        add = int(r.integers(0, n // 5 + 1))
        sets.append(np.append(r.permutation(one)[drop:], r.integers(0, 2**63, add, dtype=np.int64).view(np.uint64)))
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = np.concatenate([np.sort(s) for s in sets])
    common = np.zeros(1 << 6, bool)
    common[:: 2 if odd else 5] = True
    found = shared_pairs(at, value, np.array([len(s) for s in sets]), common)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in found


def test_sketch_never_exceeds_the_difference():
    at, value = N.shingle_sets([frames.words(n, s).encode() for n, s in ((50, 1), (60, 1), (400, 2))])
    sk = N.sketches(at, value, 3).view(np.uint64)
    for i in range(3):
        for j in range(3):
            differ = len(np.setxor1d(value[at == i], value[at == j]))
            assert int(np.bitwise_count(sk[i] ^ sk[j]).sum()) <= differ


def test_near_dedup_and_empty(spark):
    df = spark.createDataFrame(near_copies(), frames.SCHEMA)
    kept = {r["doc_id"] for r in N.near_dedup(df).collect()}
    assert kept == {c for _, _, c in brute(near_copies())}
    assert N.jaccard_groups(frames.empty(spark)).count() == 0 and N.near_dedup(frames.clashing(spark)).columns == frames.clashing(spark).columns


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r["node"]: r["label"] for r in N.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 90: 90, 95: 90, 100: 90}


def test_near_dedup_judges_rows_not_ids(spark):
    base, clean = frames.words(100, 1), frames.words(80, 7)
    near = [base + f" tail{k}" for k in range(6)]
    rows = [(1, near[0]), (5, near[1]), (5, clean), (9, near[2]), (None, near[3]), (None, near[4]),
            (20, frames.words(70, 8)), (20, frames.words(70, 8) + " more"), (None, frames.words(60, 9)), (None, frames.words(60, 9) + " more"),
            (30, frames.words(50, 3)), (30, frames.words(50, 3)), (40, ""), (40, ""), (41, None), (None, None)]
    got = [(r["doc_id"], r["text"]) for r in N.near_dedup(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], frames.SCHEMA)).collect()]
    assert [x for x in got if x[1] in near] == [(1, near[0])]
    assert got.count((5, clean)) == 1 and got.count((30, frames.words(50, 3))) == 1
    assert sum(1 for i, _ in got if i == 20) == 1 and sum(1 for i, t in got if i is None and t) == 1
    assert sorted((x for x in got if not x[1]), key=str) == sorted([(40, ""), (40, ""), (41, None), (None, None)], key=str)
    assert len(got) == 9


def test_near_dedup_drops_the_one_null_id(spark):
    text = frames.words(100, 1)
    df = spark.createDataFrame([(3, text, None, None, None), (None, text + " tail", None, None, None), (2, text + " end", None, None, None)], frames.SCHEMA)
    assert [r["doc_id"] for r in N.near_dedup(df).collect()] == [2]


def template_rows():
    """Texts that share 60 to 79 % of their shingles through a template, a few of them near copies of each other, and one group of near copies of a base."""
    r, rows = random.Random(5), []
    template = frames.words(120, 900)
    for i in range(50):
        own = frames.words(r.choice([34, 50, 70]), 1000 + i // 3 if i % 4 == 0 else 2000 + i).split()
        own[r.randrange(len(own))] = f"mark{i}"
        rows.append((len(rows), template + " " + " ".join(own), None, None, None))
    base = frames.words(200, 901).split()
    for i in range(50):
        w = list(base)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(len(w))] = f"edit{r.randrange(9999)}"
        rows.append((len(rows), " ".join(w), None, None, None))
    return rows


@pytest.mark.parametrize("block", [4, 16, 1024])
def test_lists_larger_than_a_block(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = template_rows()
    want = brute(rows)
    assert 5 < len({r[2] for r in want}) < 90
    assert run(spark, rows, bucket_bytes=4000) == want


def test_links_of_a_list_are_fewer_than_its_members():
    import pyarrow as pa
    texts = [r[1].encode() for r in template_rows()[50:]]
    at, value = N.shingle_sets(texts)
    ids = np.arange(len(texts))
    held = [value[at == i].tobytes() for i in ids]
    one = pa.array(np.zeros(len(ids), np.int64))
    batch = pa.RecordBatch.from_arrays([one, one, one, one, pa.array(ids), pa.array(ids), pa.array(held, pa.binary())], names=list("abcdefg"))
    links = [r for b in set_links.forest_batches([batch], N.sketches_of, N.may_link) for r in b.to_pylist()]
    sets = [shingles(t.decode()) for t in texts]
    assert 0 < len(links) < len(texts)
    for x in links:
        a, b = sets[x["a"]], sets[x["b"]]
        assert 100 * len(a & b) >= 80 * len(a | b)


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_components_in_one_and_several_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(N, "LINK_BLOCK", block)
    r = random.Random(1)
    links = [(i, i + 1) for i in range(12)] + [(50, x) for x in range(51, 60)] + [(59, 90), (90, 30), (-4, 70), (70, -8)]
    links = [p if r.random() < 0.5 else p[::-1] for p in links]
    group = {x: x for pair in links for x in pair}
    for a, b in links:
        low, high = min(group[a], group[b]), max(group[a], group[b])
        group = {k: low if v == high else v for k, v in group.items()}
    assert {x["node"]: x["label"] for x in N.components(spark.createDataFrame(links, "a long, b long")).collect()} == group
