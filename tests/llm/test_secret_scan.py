import re

import frames
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from strataflow.llm import secret_scan as S

RULES = S.BASE + S.MORE
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
TEXTS = ["secret:token:abcdefgh", "Token = 'abc' token=\"abcdef\"", "password=abcdefAKIA" + "Q7" * 10, "api_key:deadbeefdeadbeefdeadbeef00", "😀 passwd : zzzzzz 😀 passwd:yyyyyyy",
         "f" * 23 + " " + "0" * 24, "AKIA" + "A" * 15, "AKIA" + "A" * 16 + "a", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "no secret here", "tokens token:", "apikey=======",
         "secret=" + "a" * 100_000, "token=abcdef " * 300]


def brute(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    out += [(m.start(), 3 + i, m.end()) for i, r in enumerate(S.MORE) for m in re.finditer(r.pattern, t)]
    return sorted(out)


def test_spans(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)] + frames.rows()
    got = S.scan(spark.createDataFrame(rows, frames.SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r["spans"]] == brute(r["text"] or ""), r["text"]


def test_shuffled_candidates(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    got = S.scan(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(TEXTS)], frames.SCHEMA)).collect()
    assert all([tuple(s) for s in r["spans"]] == brute(r["text"]) for r in got)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a token=abcdef, key deadbeefdeadbeefdeadbeef.", "", "", 1), (2, None, "", "", None), (3, "password=AKIA" + "B" * 20, "", "", 1)], frames.SCHEMA)
    got = {r["doc_id"]: r["text"] for r in S.redact(S.scan(df)).collect()}
    assert got == {1: "a [REDACTED], key [REDACTED].", 2: None, 3: "[REDACTED]"}


def test_clashing_and_empty(spark):
    out = S.scan(frames.clashing(spark))
    assert out.count() == len(frames.rows()) and S.scan(frames.empty(spark)).count() == 0


def test_queries():
    assert S.trigram_query("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    assert S.trigram_query("[0-9a-f]{24,}") == S._ALL
    assert S.trigram_query("ab?cde|xyz") == {frozenset({"abc", "bcd", "cde"}), frozenset({"acd", "cde"}), frozenset({"xyz"})}
    assert frozenset({"sec", "ecr", "cre", "ret"}) in S.trigram_query(S.BASE[0].pattern)


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(["ab+c(de|fg)?hij", "(foo|ba[rz])qux{1,3}", "x{3}y*zzz", "[abc]{2}def", "a.b(cd)+efg"]), st.randoms())
def test_every_match_satisfies_its_query(pattern, r):
    text = "".join(r.choice("abcdefghijoquxyzr") for _ in range(300))
    q = S.trigram_query(pattern)
    for m in re.finditer(pattern, text):
        grams = {m[0][i:i + 3] for i in range(len(m[0]) - 2)}
        assert any(s <= grams for s in q), (pattern, m[0], q)


@pytest.mark.parametrize("gram", ["aki", "zzz"])
def test_postings(spark, gram):
    keyed = spark.createDataFrame([(1, "xAKIAx"), (2, "nothing"), (3, "")], "key long, text string")
    assert {r["key"] for r in S.postings(keyed, [gram]).where(F.col("gram") == gram).collect()} == ({1} if gram == "aki" else set())


def key_texts():
    import random

    r = random.Random(3)
    lines = ["".join(r.choice("ABCDEFghijklMNOPqrst0123456789+/") for _ in range(64)) for _ in range(25)] + ["Zk9x+Q=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C3D"
    body = "\n".join(lines)
    texts = [f"see\n{begin}\n{body}\n{end}\nafter words", f"see {begin}\n{head}\n\n{body}\n{end} after words", f"see {begin}\r\n" + "\r\n".join(lines) + "\r\nafter words",
             f"see {begin}\n{head}\n\n{body}\nafter words", f"see {begin} " + " ".join(lines) + f" {end} after words", f"see {begin}\n" + "\n".join("> " + x for x in lines) + "\nafter words",
             'see "' + begin + "\\n" + "\\n".join(lines) + "\\n" + end + '\\n" after words', 'see "' + begin + "\\n" + "\\n".join(lines) + '" after words',
             f"see {begin}\n{body}\n-----BEGIN CERTIFICATE-----\nafter words", f"see {begin}\n{lines[0][:9]}\nafter words", f"see {begin}\n" + f"{lines[0]}\n" * 40_000 + "after words",
             f"see {begin}\n" + "a-b " * 40_000 + "after words"]
    return texts, lines


def test_no_key_byte_is_left_after_redaction(spark):
    import corpus_pipeline as C

    texts, lines = key_texts()
    rows = [(i, t, None, None, len(t)) for i, t in enumerate(texts)] + [(99, "a header -----BEGIN PRIVATE KEY----- in a text", None, None, 46)]
    got = {r["doc_id"]: r["text"] for r in C.redact_secrets(spark, spark.createDataFrame(rows, frames.SCHEMA), "").collect()}
    assert got.pop(99) == "a header [REDACTED] in a text"
    for i, t in got.items():
        assert "PRIVATE KEY" not in t and not any(x[:8] in t for x in lines), (i, t[:300])
        assert t.startswith("see") and t.endswith("after words"), (i, t[-300:])


def test_reported_spans_of_a_key_stay_its_header():
    assert S.MORE[0].pattern == "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----" and S.trigram_query(S.REDACTED[3].pattern) == S.trigram_query(S.MORE[0].pattern)


def test_folds_before_each_element(spark):
    import random

    r = random.Random(2)
    rows = [(i, [r.randrange(-50, 50) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 63, 64, 65, 4096, 4097, 9000])]
    df = spark.createDataFrame(rows, "id int, v array<int>").select("id", S.before(F.col("v"), lambda a, b: a + b).alias("s"), S.before(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m"))
    for got in df.collect():
        v = rows[got["id"]][1]
        sums, most = [0], [0]
        for x in v:
            sums.append(sums[-1] + x)
            most.append(max(most[-1], x))
        assert got["s"] == sums[:-1] and got["m"] == most[:-1]


@pytest.mark.parametrize("piece, fold", [(5, 3), (4096, 64)])
def test_redaction_of_overlapping_spans_in_pieces(spark, monkeypatch, piece, fold):
    import random

    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "FOLD", fold)
    r, rows, want = random.Random(7), [], {}
    for i in range(60):
        text = "".join(r.choice("ab日😀\n ") for _ in range(r.choice([1, 4, 5, 6, 15, 16, 30, 200])))
        spans = sorted({(a, r.randrange(3), min(len(text), a + r.randint(1, 25))) for a in (r.randrange(len(text)) for _ in range(r.randrange(12)))})
        rows.append((i, text, spans))
        out, at = "", 0
        for a, _, b in spans:
            out += text[at:a] + "<>" if a >= at else ""
            at = max(at, b)
        want[i] = out + text[at:]
    rows.append((60, None, []))
    df = spark.createDataFrame(rows, "doc_id int, text string, spans array<struct<start:int,kind:int,end:int>>")
    assert {x["doc_id"]: x["text"] for x in S.redact(df, mark="<>").collect()} == want | {60: None}


def test_a_hundred_thousand_matches_in_one_text(spark):
    text = " ".join(f"token={i:06d}" for i in range(100_000))
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    scanned = S.scan(df)
    got = scanned.select(F.size("spans").alias("n"), F.element_at("spans", -1).alias("last")).first()
    assert got["n"] == 100_000 and (got["last"]["start"], got["last"]["end"]) == (len(text) - 12, len(text))
    assert S.redact(scanned).first()["text"] == " ".join(["[REDACTED]"] * 100_000)
