import frames
import numpy as np
import pytest
from strataflow.llm import labelled as L
from strataflow.llm import quality as Q
from strataflow.llm import toxicity as T
from strataflow.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    _, inverse, count = np.unique(s, return_inverse=True, return_counts=True)
    ends = np.cumsum(count)
    rank = (ends - (count - 1) / 2)[inverse]
    del order
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.8), ("op8_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, sf01, name, label, least):
    got = QUERIES[name](spark, sf01).join(spark.read.parquet(f"{sf01}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert auc(held[label].to_numpy(), held.score.to_numpy()) > least


def test_fold_is_crc32_of_the_id(spark, sf01):
    import zlib

    got = QUERIES["op8_quality"](spark, sf01).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


@pytest.mark.parametrize("module", [Q, T])
def test_awkward_rows(spark, module):
    docs = frames.clashing(spark)
    for labels in ([], [(0, 1, 1)], [(i, i % 2, i % 2) for i in range(18)], [(None, 1, 1), (3, None, None), (4, 7, 7)]):
        model = module.fit(docs, spark.createDataFrame(labels, LABELS))
        out = module.score(docs, model)
        rows = out.collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert set(out.columns) >= {"doc_id", "text", "score", "predicted"}
        by_text = {}
        for r in rows:
            assert by_text.setdefault(r["text"], r["score"]) == r["score"]
    assert module.score(frames.empty(spark), model).count() == 0


def test_whole_text_counts():
    clean = frames.words(3000, 1)
    assert T.features(clean + " idiot", frozenset())[1] > 0 and T.features("1d10t you m0ron", frozenset())[13] > 0
    assert T.features(None, frozenset()) == T.features("", frozenset()) == [0.0] * len(T.FEATURES)
    near, far = T.features("you idiot", frozenset()), T.features("you " + clean + " idiot", frozenset())
    assert near[5] > 0 and far[5] == 0


def test_difference_prefers_the_matching_dictionary():
    good = [frames.words(60, k).encode() for k in range(200)]
    bad = [("BUY!! " * 20 + frames.words(5, k).upper() + "%%% $$$").encode() for k in range(200)]
    a, b = Q._dictionary(good), Q._dictionary(bad)
    assert Q.size_difference(frames.words(60, 999), a, b) > Q.size_difference("BUY!! BUY!! NOW%%% $$$ BUY!! X%%%", a, b)
    assert Q.size_difference("", a, b) is None and Q._dictionary([]) == b"" and Q.size_difference("text", b"", b"") == 0


def test_logistic_fit():
    x = np.linspace(-1, 1, 400)
    slope, intercept = L.logistic_fit(x, (x > 0.2).astype(float))
    assert slope > 0 and -intercept / slope == pytest.approx(0.2, abs=0.05)
    assert L.logistic_fit(np.array([]), np.array([])) == (0.0, 0.0)
