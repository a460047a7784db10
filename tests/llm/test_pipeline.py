"""The pipeline against plain versions of its stages."""

import re

import corpus_pipeline as C
import frames
import pytest
from strataflow.llm import quality
from strataflow.llm.queries import fold
from strataflow.llm.tables import read_table
from test_ngram_join import shingles
from test_secret_scan import brute as secrets
from tokenizers import Tokenizer


def merged(spans):
    out = []
    for a, _, b in spans:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_run_matches_plain_stages(spark, sf):
    import public_tokenizers

    docs = read_table(spark, sf, "documents")
    model = quality.fit(docs, read_table(spark, sf, "labels").where(~fold(5, 0)))
    good = {r["doc_id"] for r in quality.score(docs, model, ["doc_id"]).where("predicted = 1").collect()}
    left = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    last = {}
    for i, t in left.items():
        last[t] = max(last.get(t, i), i)
    left = {i: t for t, i in last.items()}
    sets, group = {i: shingles(t) for i, t in left.items()}, {i: i for i in left}
    ids = sorted(left)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    left = {i: t for i, t in left.items() if group[i] == i}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = {}
    for i, t in left.items():
        for a, b in reversed(merged(secrets(t))):
            t = t[:a] + "[REDACTED]" + t[b:]
        want[i] = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    got = C.run(spark, sf).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want
    assert sum(r["length"] for r in got) == sum(want.values())


def test_stages_keep_the_columns_and_take_awkward_rows(spark, sf001):
    docs = frames.plain(spark)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf001)
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        out.collect()
        assert stage(spark, frames.empty(spark), sf001).count() == 0, name
    assert C.STAGES[-1][1](spark, docs, sf001).count() >= docs.count()


def test_clean_documents_stay(spark, sf001):
    docs = spark.createDataFrame([(i, "A clean and simple sentence about the number " + frames.words(120, i), "en", "s", 1) for i in range(20)], frames.SCHEMA)
    for name, stage in C.STAGES[1:4]:
        assert sorted(r["text"] for r in stage(spark, docs, sf001).collect()) == sorted(r["text"] for r in docs.collect()), name


def test_secrets_are_gone(spark, sf001):
    docs = spark.createDataFrame([(1, "password = hunter2222 and more", "en", "s", 30)], frames.SCHEMA)
    r = C.redact_secrets(spark, docs, sf001).collect()[0]
    assert r["text"] == "[REDACTED] and more" and r["n_chars"] == len(r["text"]) and not re.search("hunter", r["text"])
