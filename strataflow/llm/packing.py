"""Packing by non-negative least squares.

Documents become token ids (byte-level BPE, plus one end id) and are cut into
pieces of at most one window. Piece lengths are rounded up to length classes;
every shallow combination of classes that fills a window exactly is a
strategy. Non-negative least squares finds how often to repeat each strategy
so that the repeats use up the histogram of classes; the repeats are rounded
down and what is left over is packed greedily, largest class first. All of
that works on the histogram (one count per class) on the driver; the pieces
themselves are numbered within their class by Spark and look their place up
in the plan by that number.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship_code, written

#: Token ids in a sequence.
WINDOW = 2048
#: Lengths are rounded up to multiples of this for planning.
CLASS_WIDTH = 16
#: Pieces in a strategy at most; greedy sequences may hold more.
DEPTH = 3
#: Pieces that one task numbers.
ROWS_PER_BUCKET = 1024
END_ID = 1
#: White-space characters in a row from which a text goes to the tokenizers file.
LONGEST_SPACE = 1000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The vocabulary's encoder, and one whose pattern needs no look-ahead, for texts without runs of white space."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = public_tokenizers.PATTERN
    tail = r"|\s+(?!\S)|\s+"
    assert pattern.endswith(tail)
    make = lambda name, pat: tiktoken.Encoding(name, pat_str=pat, mergeable_ranks=ranks, special_tokens={})
    return make("whole", pattern), make("single", pattern.removesuffix(tail) + r"|\s")


@lru_cache(maxsize=2)
def _slow_texts(path: str) -> regex.Pattern:
    """Texts that only the tokenizers file encodes as it must be: with a special token, or white space too long for the rank encoder's look-ahead."""
    with open(_tokenizer_path(path), encoding="utf-8") as f:
        special = [regex.escape(t["content"]) for t in json.load(f)["added_tokens"]]
    return regex.compile("|".join([*special, rf"\s{{{LONGEST_SPACE}}}"]))


def _tokenizer_path(path: str) -> str:
    return path.removesuffix(".tiktoken") + ".json"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_tokenizer_path(path))


_RUN = regex.compile(r"\s\s")


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a whole text (null: empty) by the tokenizers file with its default settings, and the end id.

    The rank encoder is faster and gives the same ids for all but ``_slow_texts``."""
    text = text or ""
    if _slow_texts(path).search(text):
        ids = _tokenizer(path).encode(text, add_special_tokens=False).ids
    else:
        whole, single = _encoders(path)
        ids = (whole if _RUN.search(text) else single).encode_ordinary(text)
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


def _piece_batches(batches: Iterable[pa.RecordBatch], path: str, window: int, with_ids: bool,
                   schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    per_batch = 4096 if not with_ids else 256
    for batch in batches:
        rows: list[tuple] = []
        texts, doc_ids = batch.column(1), batch.column(0)
        for k in range(batch.num_rows):
            ids, doc_id = token_ids(texts[k].as_py(), path), doc_ids[k].as_py()
            for start in range(0, len(ids), window):
                piece = ids[start:start + window]
                row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                rows.append(row + ((piece.astype("int32"),) if with_ids else ()))
            if len(rows) >= per_batch:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def pieces(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: full windows from the start of each document, then the rest."""
    ship_code(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType
    names = [("doc_id", kind.simpleString()), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint")]
    names += [("ids", "array<int>")] if with_ids else []
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = ", ".join(f"{n} {t}" for n, t in names)
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        lambda it: _piece_batches(it, path, window, with_ids, schema), ddl)


def strategies(classes: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All combinations of at most ``depth`` classes (largest first) that sum to ``classes``."""
    def extend(left: int, most: int, parts: int) -> Iterator[tuple[int, ...]]:
        if not left:
            yield ()
        elif parts:
            for first in range(min(left, most), 0, -1):
                for rest in extend(left - first, first, parts - 1):
                    yield (first, *rest)
    return list(extend(classes, classes, depth))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """min |a x - b| over x >= 0, by active sets: free the most promising column, solve, drop what turns negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    eps = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        best = int(gradient.argmax())
        if free.all() or gradient[best] <= eps:
            break
        free[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (trial <= 0)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            free &= x > eps * 1e-3
            x[~free] = 0
            if not free.any():
                break
        x = np.where(free, trial, 0)
    return x


def plan(histogram: dict[int, int], classes: int = WINDOW // CLASS_WIDTH, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(classes of a sequence, repeats): together they use every counted piece exactly once."""
    left = Counter({c: n for c, n in histogram.items() if n})
    out: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], repeats: int) -> None:
        if repeats > 0:
            out.append((combo, repeats))
            for c, k in Counter(combo).items():
                left[c] -= k * repeats

    room = lambda combo: min(left[c] // k for c, k in Counter(combo).items())
    combos = [s for s in strategies(classes, depth) if all(left[c] for c in s)]
    if combos:
        a = np.zeros((classes, len(combos)))
        for j, combo in enumerate(combos):
            for c in combo:
                a[c - 1, j] += 1
        b = np.array([left[c] for c in range(1, classes + 1)], dtype=float)
        repeats = nnls(a, b / b.max()) * b.max()
        for j in np.argsort(-repeats, kind="stable"):
            take(combos[j], min(int(repeats[j] + 1e-6), room(combos[j])))
    while +left:
        combo, space = [], classes
        spare = Counter(+left)
        while fits := [c for c, n in spare.items() if n and c <= space]:
            c = max(fits)
            combo.append(c)
            spare[c] -= 1
            space -= c
        take(tuple(combo), room(tuple(combo)))
    return out


def placements(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first number, end number, first sequence, place in the sequence) of every run of equally placed pieces."""
    used: Counter[int] = Counter()
    out, sequence = [], 0
    for combo, repeats in planned:
        for place, c in enumerate(combo):
            out.append((c, used[c], used[c] + repeats, sequence, place))
            used[c] += repeats
        sequence += repeats
    return out


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, width: int = CLASS_WIDTH, depth: int = DEPTH,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with ``sequence_id`` (gapless from 0) and ``offset`` (gapless from 0 in each sequence).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids). A null or empty text is one piece of the end id alone. Repeated
    rows are packed as often as they occur. Other columns are not read. An
    empty table gives an empty result. A long text is cut into full windows,
    whichever task reads it; no group of pieces is larger than a bucket.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, vocabulary, window, with_ids, id_col, text_col), "pieces")
    cut = cut.withColumn("class", F.ceil(F.col("length") / width).cast("int"))
    counts = {r["class"]: r["count"] for r in cut.groupBy("class").count().collect()}
    runs = placements(plan(counts, window // width, depth))
    where = spark.createDataFrame(runs, "class int, first bigint, end bigint, sequence bigint, place int")
    buckets = max(1, sum(counts.values()) // ROWS_PER_BUCKET)
    # rows that agree in all of these are alike, so a task that runs again numbers them alike
    order = ["doc_id", "start", "doc_tokens", "length", "ids_crc32"]
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = cut.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("class", "bucket").orderBy(*order)) - 1
    numbered = (cut.withColumn("row", number).join(bases.hint("shuffle_hash"), ["class", "bucket"])
                .withColumn("number", F.col("row") + F.col("base")))
    # the plan has a few runs per class, however many pieces there are
    placed = numbered.join(F.broadcast(where), "class").where("number >= first and number < end")
    in_sequence = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("sequence_id", F.col("sequence") + F.col("number") - F.col("first"))
            .withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0)))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids))
