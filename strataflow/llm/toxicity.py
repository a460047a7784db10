"""Toxicity by gradient-boosted trees over dense features.

Per document: densities of two lexicons (a short fixed one and one learnt
from labelled rows), how often a lexicon word stands near a word of the
second person, shares of capitals and punctuation, and how often words are
disguised by digits or signs. Boosted trees score the features, an isotonic
fit on rows that the trees have not seen makes the score a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_rows
from .tables import ship_code, without, written

#: Labelled rows read for fitting: four fifths for the lexicon and the trees (in two halves, crosswise), the rest for the calibration.
FIT_ROWS = 24_000
#: Words and stems that the learnt lexicon holds at most.
LEARNT_WORDS = 64
#: How many times as often toxic documents must hold a sure entry, and a broad stem.
SURE_RATIO, BROAD_RATIO = 40, 4
#: Lengths of word beginnings that may be learnt as stems (written with a star).
STEMS = (3, 4, 5)
#: Words within this distance count as near.
NEAR = 5
#: Words in the window whose lexicon hits are counted together.
WINDOW = 50

# Common insults and second-person words of the corpus languages, and signs used for letters.
INSULTS = ("arschloch bastard clown cretin depp disgusting dumm dummkopf dumb fool garbage hateful idiot idiota idiote imbecile "
           "imbécil imbécile jerk loser miststück moron nasty pathetic pendejo scum shut stupid stupide trash trottel ugly "
           "verpiss worthless").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted vos".split()
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "*": ""})

FEATURES = ("insult_density", "insult_count", "learnt_density", "learnt_count", "near_you_density", "near_you_count", "dense_window",
            "capitals", "capital_words", "exclamations", "punctuation", "digits", "disguised", "disguised_insults", "broad_density", "broad_count", "length")

_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"(?<!\S)[a-z]+[0-9@$!*]+[a-z][a-z0-9@$!*]*")
_SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
_INSULTS, _SECOND = frozenset(INSULTS), frozenset(SECOND_PERSON)
_PUNCTUATION = np.array([chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in range(256)])


def features(text: str | None, learnt: frozenset[str], broad: frozenset[str] = frozenset()) -> list[float]:
    """The dense features of a whole text, in the order of FEATURES; zeros for no text."""
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode()
    low = text.lower()
    words = _WORD.findall(low)
    per_word = 100.0 / max(1, len(words))
    insults = [i for i, w in enumerate(words) if w in _INSULTS]
    known = [i for i, w in enumerate(words) if w in learnt or w[:5] + "*" in learnt or w[:4] + "*" in learnt or w[:3] + "*" in learnt]
    loose = sum(w[:5] + "*" in broad or w[:4] + "*" in broad or w[:3] + "*" in broad for w in words)
    both = sorted({*insults, *known})
    near = sum(any(w in _SECOND for w in words[max(0, i - NEAR):i + NEAR + 1]) for i in both)
    dense, first = 0, 0
    for k, i in enumerate(both):
        while both[first] <= i - WINDOW:
            first += 1
        dense = max(dense, k - first + 1)
    disguised = _DISGUISED.findall(low)
    meant = sum(w.translate(SIGNS) in _INSULTS or w.translate(SIGNS) in learnt for w in disguised)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = len(data)
    return [len(insults) * per_word, math.log1p(len(insults)), len(known) * per_word, math.log1p(len(known)),
            near * per_word, math.log1p(near), float(dense), counts[65:91].sum() / n, len(_SHOUTED.findall(data)) * per_word,
            (counts[33] + counts[63]) / n, counts[_PUNCTUATION].sum() / n, counts[48:58].sum() / n,
            len(disguised) * per_word, math.log1p(meant), loose * per_word, math.log1p(loose), math.log1p(len(words))]


def _feature_batches(batches: Iterable[pa.RecordBatch], learnt: frozenset[str], broad: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Column 0, the text, becomes its features; the others stay."""
    for batch in batches:
        seen: dict[str | None, list[float]] = {}
        out = []
        for value in batch.column(0):
            text = value.as_py()
            if text not in seen:
                seen[text] = features(text, learnt, broad)
            out.append(seen[text])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())), *batch.columns[1:]], names=["features", *batch.schema.names[1:]])


def with_features(docs: DataFrame, keep: list[str], learnt: Iterable[str] = (), broad: Iterable[str] = ()) -> DataFrame:
    ship_code(docs.sparkSession)
    words, stems = frozenset(learnt), frozenset(broad)
    kept = docs.select(F.col("text").alias("__text"), *[F.col(f"`{c}`") for c in keep])
    schema = "features array<double>" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(lambda it: _feature_batches(it, words, stems), schema)


def learn_lexicon(rows: DataFrame, words: int = LEARNT_WORDS) -> tuple[list[str], list[str]]:
    """Entries that all but prove toxicity, and stems that are only more frequent there; the most telling first (log-likelihood ratio)."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).first()
    n, bad = totals["n"], totals["bad"] or 0
    if not 0 < bad < n:
        return [], []
    split = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    stem = lambda n: F.transform(F.filter(split, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
    entries = F.array_distinct(F.concat(split, *[stem(n) for n in STEMS]))
    counted = (rows.select("label", F.explode(entries).alias("word")).where(F.length("word") >= 3)
               .groupBy("word").agg(F.sum("label").alias("k"), F.count(F.lit(1)).alias("m")))
    part = lambda x, mean: F.when(x > 0, x * F.log(x / mean)).otherwise(0.0)
    rate = F.col("m") * (bad / n)
    gain = part(F.col("k"), rate) + part(F.col("m") - F.col("k"), F.col("m") - rate)
    ratio = (F.col("k") / bad) / ((F.col("m") - F.col("k") + 0.25) / (n - bad))
    best = (counted.where((F.col("k") >= max(2, bad // 100)) & (ratio > BROAD_RATIO)).withColumn("ratio", ratio)
            .orderBy(F.round(gain, 3).desc(), F.length("word").desc(), "word").limit(16 * words).collect())

    def chosen(entries: list[str]) -> list[str]:
        """Without what a chosen stem covers or a chosen entry makes superfluous."""
        out: list[str] = []
        for e in entries:
            start = e.rstrip("*")
            if not any(c.endswith("*") and start.startswith(c[:-1]) or e.endswith("*") and c.startswith(start) for c in out):
                out.append(e)
        return out[:words]

    return (chosen([r["word"] for r in best if r["ratio"] > SURE_RATIO]),
            chosen([r["word"] for r in best if r["word"].endswith("*")]))


@dataclass
class ToxicityModel:
    learnt: list[str]
    broad: list[str]
    trees: Any
    isotonic: Any
    prior: float


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> ToxicityModel:
    """Fitted on a bounded sample of the labelled rows given (about ``rows``, smallest id hashes).

    With no labelled rows, or one class only among the trees' rows, every
    document gets the (smoothed) share of label 1; without both classes among
    the calibration rows the trees' own probability is the score.
    """
    sample = labelled_rows(docs, labels, label, rows)
    one, two, last = (sample.where((F.col("part") >= a) & (F.col("part") < b)) for a, b in ((0.0, 0.4), (0.4, 0.8), (0.8, 1.0)))
    # the trees see each half through the lexicon of the other one, as new documents are seen through the final lexicon
    learnt, broad = learn_lexicon(sample.where("part < 0.8"))
    seen = [with_features(own, ["label"], *learn_lexicon(other)) for own, other in ((one, two), (two, one))]
    vectors = lambda df: df.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    grown, held = written(vectors(seen[0].unionByName(seen[1])), "toxic-rows"), written(vectors(with_features(last, ["label"], learnt, broad)), "toxic-rows")
    (n1, k1), (n2, k2) = ((a, b or 0) for a, b in (f.agg(F.count(F.lit(1)), F.sum("label")).first() for f in (grown, held)))
    prior = float((k1 + k2 + 0.5) / (n1 + n2 + 1)) if n1 + n2 else 0.0
    if not 0 < k1 < n1:
        return ToxicityModel(learnt, broad, None, None, prior)
    per_task = max(1, min(8, n1 // 2000))
    trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, maxBins=32, seed=1, minInstancesPerNode=5).fit(grown.coalesce(per_task))
    isotonic = None
    if 0 < k2 < n2:
        margin = trees.transform(held.coalesce(per_task)).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
        isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margin)
    return ToxicityModel(learnt, broad, trees, isotonic, prior)


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """The columns ``keep`` (default: all) with ``score`` in [0, 1] and ``predicted`` (score >= threshold).

    Whole texts are scored; null and empty texts have zeros for features and
    get the score of those. Input columns named score or predicted are
    replaced. Equal texts get equal scores.
    """
    added = {"score", "predicted", "features", "margin", "rawprediction", "probability", "prediction"}
    docs = without(docs, added)
    names = [c for c in (keep or docs.columns) if c in docs.columns]
    if model.trees is None:
        out = docs.select(*names).withColumn("score", F.lit(model.prior))
    else:
        out = with_features(docs, names, model.learnt, model.broad).withColumn("features", array_to_vector("features"))
        out = model.trees.transform(out).withColumn("margin", vector_to_array("rawPrediction")[1])
        own = 1 / (1 + F.exp(-2 * F.col("margin")))
        if model.isotonic is None:
            out = out.withColumn("score", own)
        else:  # the isotonic steps are flat; a small share of the trees' own probability keeps the order within a step
            out = model.isotonic.transform(out).withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("score") + 0.001 * own)))
        out = out.select(*names, "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
