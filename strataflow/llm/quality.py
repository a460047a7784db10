"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts. A text is compressed with each, block by block over its whole length;
the difference of the two sizes divided by the text's length is the figure
that a logistic fit on other labelled rows turns into a probability of label 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_rows, logistic_fit
from .tables import ship_code, without

#: Labelled rows read for fitting, dictionary and calibration together.
FIT_ROWS = 20_000
#: Texts that a dictionary is built from, each of at most SAMPLE_BYTES.
SAMPLE_TEXTS, SAMPLE_BYTES = 1500, 20_000
DICTIONARY_BYTES = 32_768
#: A text is compressed in blocks of this many bytes; small blocks let the dictionary matter.
BLOCK = 512
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    prior: float


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[:DICTIONARY_BYTES]


_COMPRESSORS: dict[bytes, zstandard.ZstdCompressor] = {}


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if dictionary not in _COMPRESSORS:
        if not dictionary:
            return zstandard.ZstdCompressor(level=LEVEL)
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=LEVEL)
        _COMPRESSORS[dictionary] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d)
    return _COMPRESSORS[dictionary]


def size_difference(text: str | None, good: bytes, bad: bytes) -> float | None:
    """(size with the bad dictionary - size with the good one) / length; None for no text."""
    data = (text or "").encode()
    if not data:
        return None
    with_good, with_bad = _compressor(good).compress, _compressor(bad).compress
    gap = 0
    for i in range(0, len(data), BLOCK):
        block = data[i:i + BLOCK]
        gap += len(with_bad(block)) - len(with_good(block))
    return gap / len(data)


def _differences(batches: Iterable[pa.RecordBatch], good: bytes, bad: bytes) -> Iterator[pa.RecordBatch]:
    """Column 0, the text, becomes the figure; the others stay."""
    for batch in batches:
        seen: dict[str | None, float | None] = {}
        out = []
        for value in batch.column(0):
            text = value.as_py()
            if text not in seen:
                seen[text] = size_difference(text, good, bad)
            out.append(seen[text])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), *batch.columns[1:]], names=["difference", *batch.schema.names[1:]])


def _with_difference(rows: DataFrame, keep: list[str], good: bytes, bad: bytes) -> DataFrame:
    ship_code(rows.sparkSession)
    kept = rows.select(F.col("text").alias("__text"), *[F.col(f"`{c}`") for c in keep])
    schema = "difference double" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(lambda it: _differences(it, good, bad), schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> QualityModel:
    """Fitted on a bounded sample of the labelled rows given (about ``rows``, smallest id hashes).

    One half of the sample gives the dictionaries, from distinct texts; the
    other half the calibration. Without labelled rows the score is 0.5
    everywhere, with one class only it is that class's smoothed share.
    """
    sample = labelled_rows(docs, labels, label, rows)
    usable = sample.where((F.col("part") < 0.5) & F.octet_length("text").between(1, SAMPLE_BYTES))
    texts: dict[int, list[bytes]] = {}
    for k in (0, 1):
        one = usable.where(F.col("label") == k)
        ids = (one.groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).orderBy("h").limit(SAMPLE_TEXTS))
        texts[k] = [r["text"].encode() for r in one.join(F.broadcast(ids.select("doc_id")), "doc_id").select("text").orderBy(F.xxhash64("text")).collect()]
    good, bad = _dictionary(texts[1]), _dictionary(texts[0])
    rest = _with_difference(sample.where("part >= 0.5"), ["label"], good, bad).where("difference is not null").collect()
    y = np.array([r["label"] for r in rest], dtype=float)
    slope, intercept = logistic_fit(np.array([r["difference"] for r in rest]), y)
    return QualityModel(good, bad, max(0.0, slope), intercept, float((y.sum() + 0.5) / (len(y) + 1)))


def score(docs: DataFrame, model: QualityModel, keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """The columns ``keep`` (default: all) with ``score`` in [0, 1] and ``predicted`` (score >= threshold).

    Whole texts are scored. Null and empty texts get the share of label 1
    among the calibration rows. Input columns named score or predicted are
    replaced. Equal texts get equal scores.
    """
    docs = without(docs, {"score", "predicted", "difference"} - {"text"})
    names = [c for c in (keep or docs.columns) if c in docs.columns]
    out = _with_difference(docs, names, model.good, model.bad)
    p = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("difference") + F.lit(model.intercept))))
    return (out.withColumn("score", F.coalesce(p, F.lit(model.prior)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("difference"))
