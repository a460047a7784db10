import random
import re
from collections import Counter, defaultdict

import frames
import numpy as np
import pytest
from strataflow.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain_counts(rows):
    f, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            size[lang or "und"] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    return f, size


def brute(rows, least, top=2000):
    f, size = plain_counts(rows)
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for q, b in found.items()):
                continue
            cuts = [(1000 * a * size[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, size[lang], -score))
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)], frames.SCHEMA)
    return sorted(tuple(r) for r in C.collocations(df, **more).collect())


def prose(n, seed, vocabulary=12):
    r = random.Random(seed)
    words = ["the", "Of", "a", "naïve", "日本", "x-y", "\x00", "\x1c", "\xa0z", "and", "deep", "sea"][:vocabulary]
    fixed = "new york times square tonight"
    return "".join(r.choice([fixed, r.choice(words), r.choice(words)]) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\r\n", ", ", "?! "]) for _ in range(n))


def test_equals_brute_force(spark):
    rows = [(r, prose(120, i)) for i, r in enumerate(["en", "en", "de", None, "und", "en"])] * 2 + [("en", None), ("en", ""), ("fr", " \n. "), (None, "one")]
    for least in (2, 3, 9):
        assert run(spark, rows, least=least, bucket_bytes=500) == brute(rows, least)


def test_ranks_and_ties(spark):
    rows = [("en", ". ".join(f"w{i} v{i}" for i in range(40)))] * 3
    got = run(spark, rows, least=3, top=5)
    assert got == brute(rows, 3, 5)
    assert [r[2] for r in got] == sorted(f"w{i} v{i}" for i in range(40))[:5]


def test_awkward_rows(spark):
    rows = [(r[2], r[1]) for r in frames.rows()]
    df = frames.clashing(spark)
    got = sorted(tuple(r) for r in C.collocations(df, least=3).collect())
    assert got == brute(rows, 3)
    assert C.collocations(frames.empty(spark)).collect() == []


def test_products_beyond_64_bits(spark):
    size = spark.createDataFrame([("a", 3_000_000_000_000)], "p string, a long").selectExpr(
        "cast(a as decimal(19,0)) * cast(a * 3 as decimal(19,0)) * cast(1000 as decimal(4,0)) as p", "cast(a as decimal(19,0)) * cast(a + 7 as decimal(19,0)) as q")
    a = 3_000_000_000_000
    assert size.selectExpr("p div q as s").first()["s"] == 1000 * a * 3 * a // (a * (a + 7))


@pytest.mark.parametrize("limit", [40, 10**6])
def test_bursting_spilling_and_new_ids(monkeypatch, limit):
    monkeypatch.setattr(C, "BURST", 4)
    monkeypatch.setattr(C, "LIMIT", limit)
    monkeypatch.setattr(C, "STEP", 32)
    monkeypatch.setattr(C, "MAX_IDS", 90)
    texts = [prose(200, s) + " " + frames.words(60, s) for s in range(5)]
    runs, known = defaultdict(list), np.full(1 << (C.FILTER_BITS - 6), 2**64 - 1, dtype=np.uint64)
    for shortest, longest in ((1, 1), (2, 2), (3, 5)):
        counter = C.PhraseCounter(shortest, longest, 7, known, lambda lang, bucket, run: runs[lang, bucket].append(run))
        for i, t in enumerate(texts):
            counter.feed("en" if i % 2 else "de", [t.encode(), b"", texts[0].encode()])
        counter.flush()
    got = defaultdict(Counter)
    for (lang, _), blobs in runs.items():
        phrases, counts = C.merged(blobs)
        assert phrases.to_pylist() == sorted(phrases.to_pylist())
        for p, n in zip(phrases.to_pylist(), counts, strict=True):
            assert tuple(p.decode().split(" ")) not in got[lang]   # a phrase lies in one partition
            got[lang][tuple(p.decode().split(" "))] += int(n)
    want, _ = plain_counts([("en" if i % 2 else "de", t) for i, t in enumerate(texts)] + [("en" if i % 2 else "de", texts[0]) for i in range(5)])
    assert got == want


def test_containers_burst_below_a_hot_word(monkeypatch):
    monkeypatch.setattr(C, "BURST", 16)
    trie = C.HatTrie()
    codes = [5 | second << C.ID_BITS for second in range(1, 600)]
    trie.add(codes, [1] * len(codes))
    trie.add(codes, [2] * len(codes))
    assert type(trie.root[5]) is list and trie.sizes[5] == len(codes)
    got = dict(zip(*trie.cut(5), strict=True))
    assert got == dict.fromkeys(codes, 3) and trie.sizes[5] == 0
