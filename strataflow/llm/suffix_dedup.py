"""Suffix-array dedup by a depth-limited radix sort.

Suffixes of all texts (as bytes) are ordered only through ``depth`` bytes, by
most-significant-digit passes; what is equal after the last digit is exactly a
window of ``depth`` bytes that occurs more than once.

* The first digit is the least 6-byte gram of the window, in an order that puts
  rare grams (by a bounded sample) first and then goes by hash. It deals
  the windows out to buckets (the one exchange of the sort), and as
  neighbouring windows mostly share it, a run of them travels as one piece of
  text instead of window by window.
* Equal runs are combined in each chunk before the exchange, and again while a
  bucket is read: only the smallest document of each is sorted on, however many
  copies there are. The others are reported covered at once.
* The next digits are the first HEAD bytes, then the rest. Windows whose
  group has one document after a digit are dropped before the next.

Every window that also starts in a document with a smaller id is reported as
a byte range to its document, where the ranges are joined and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import join_small_or_hot, ship_code, shuffle_partitions, written

DEPTH = 50
#: Bytes of the second digit; the third is the rest.
HEAD = 24
GRAM = 6
#: Bytes of text that a map task works on at a time; longer texts are taken in overlapping parts.
CHUNK = 4 << 20
#: Bytes of text whose windows one bucket holds on average, and windows of a bucket that are sorted at a time.
BUCKET_BYTES, SORTED_WINDOWS = 4 << 20, 1 << 19
#: Windows of a bucket that are read before equal runs are combined.
MERGED_WINDOWS = 1 << 22
#: Bytes of text in a partition of the last step.
PART_BYTES = 16 << 20
#: Texts sampled, and the bytes each may have, to see which grams are frequent; bits of the table of them. Only balance depends on it.
SAMPLE_TEXTS, SAMPLE_BYTES, CLASS_BITS = 1024, 32_768, 20
#: Grams counted less than 2**RARE times there are alike: a hash order among most grams makes the longest runs.
RARE = 5
#: Parts in which the texts of one id are numbered.
SPREAD = 1024
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as a number (a view)."""
    return np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))


def _mix(key: np.ndarray, digit: np.ndarray) -> np.ndarray:
    key = (key ^ digit) * _M2
    return key ^ (key >> np.uint64(29))


def _hashed(words: np.ndarray) -> np.ndarray:
    """Hash of the first GRAM of 8 bytes."""
    return (((words << np.uint64(8 * (8 - GRAM))) * _M1) >> np.uint64(32)).astype(np.uint32)


def _grams(words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Grams as numbers whose least makes the digit: rare ones (by the classes of a sample) first, then by hash."""
    hashed = _hashed(words)
    return classes[hashed >> np.uint32(32 - CLASS_BITS)] | (hashed >> np.uint32(4))


def gram_classes(texts: Iterable[bytes]) -> np.ndarray:
    """For the leading bits of a gram's hash, the bit length of its count in a sample beyond RARE, in the highest 4 bits.

    Without it a frequent gram of small hash would be the digit of a fixed share of all windows."""
    count = np.zeros(1 << CLASS_BITS, dtype=np.int64)
    for text in texts:
        words = _words(np.frombuffer(text + bytes(8), dtype=np.uint8))[:max(0, len(text) - GRAM + 1)]
        count += np.bincount(_hashed(words) >> np.uint32(32 - CLASS_BITS), minlength=1 << CLASS_BITS)
    return np.clip(np.ceil(np.log2(count + 1)) - RARE, 0, 15).astype(np.uint32) << np.uint32(28)


def _runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, buckets: int, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first position, windows, bucket) of the runs of windows in parts [start, end) that share their first digit."""
    grams = depth - GRAM + 1
    low = _grams(_words(data), classes)
    span = 1
    while 2 * span <= grams:  # minimum over ``span`` grams from each position
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < grams:
        low = np.minimum(low[:len(low) - (grams - span)], low[grams - span:])
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    holds = ends - starts >= depth
    np.add.at(inside, starts[holds], 1)
    np.add.at(inside, ends[holds] - depth + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    digit = low[at]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (np.diff(at) != 1) | (digit[1:] != digit[:-1])
    # windows of two texts never run together
    borders = np.searchsorted(at, starts[holds])
    first[borders] = True
    begin = np.flatnonzero(first)
    windows = np.diff(np.append(begin, len(at)))
    bucket = ((digit[begin].astype(np.uint64) * _M3) >> np.uint64(32)) % np.uint64(buckets)
    return at[begin], windows, bucket.astype(np.int64)


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces [start, start + length) of ``data`` one after another."""
    before = np.cumsum(lengths) - lengths
    kind = np.int32 if len(data) < 1 << 28 else np.int64
    return data[np.repeat((starts - before).astype(kind), lengths) + np.arange(int(lengths.sum()), dtype=kind)]


def _group_minimum(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element the smallest id with its key, and whether a different id shares the key."""
    order = np.argsort(key)
    sorted_key, sorted_ids = key[order], ids[order]
    first = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])) if len(key) else np.empty(0, np.int64)
    if not len(first):
        return ids, np.empty(0, bool)
    count = np.diff(np.append(first, len(key)))
    low, high = np.minimum.reduceat(sorted_ids, first), np.maximum.reduceat(sorted_ids, first)
    smallest, shared = np.empty_like(ids), np.empty(len(ids), dtype=bool)
    smallest[order], shared[order] = np.repeat(low, count), np.repeat(low != high, count)
    return smallest, shared


def _run_keys(words: np.ndarray, at: np.ndarray, windows: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the text of each run, equal only for equal texts: every word goes in with its place in the run, then the last window."""
    keys = np.empty(len(at), dtype=np.uint64)
    ends = np.cumsum(windows)
    a = 0
    while a < len(at):  # about SORTED_WINDOWS windows at a time
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + SORTED_WINDOWS)))
        size = windows[a:b]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        mixed = _mix(words[np.repeat(at[a:b], size) + place], place.astype(np.uint64) * _M1) * _M3
        last = at[a:b] + size - 1
        tail = _mix(np.zeros(len(size), dtype=np.uint64), size.astype(np.uint64))
        for k in [*range(0, depth - 8, 8), depth - 8]:
            tail = _mix(tail, words[last + k])
        keys[a:b] = np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), first) + tail
        a = b
    return keys


def _combined(run: np.ndarray, keys: np.ndarray, place: np.ndarray, texts_per_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Of runs by their hash: which go on (those of the smallest id, each place once), and which also are in a smaller id."""
    ids = keys // texts_per_id
    smallest, _ = _group_minimum(run, ids)
    copy = ids > smallest
    keep = np.flatnonzero(~copy)
    order = np.lexsort((place[keep], keys[keep], run[keep]))
    keep = keep[order]
    fresh = np.ones(len(keep), dtype=bool)
    fresh[1:] = (np.diff(run[keep]) != 0) | (np.diff(keys[keep]) != 0) | (np.diff(place[keep]) != 0)
    return np.sort(keep[fresh]), copy


def _range_parcels(keys: np.ndarray, low: np.ndarray, high: np.ndarray, parts: int) -> tuple[np.ndarray, list[bytes]]:
    """Ranges by part, packed; those of one text that meet become one."""
    press = zstandard.ZstdCompressor(level=1).compress
    if not len(keys):
        return np.empty(0, np.int64), []
    order = np.lexsort((low, keys))
    keys, low, high = keys[order], low[order], high[order]
    other = np.append(True, keys[1:] != keys[:-1])
    base = np.cumsum(other) << 32  # beyond the bytes of any text
    reach = np.maximum.accumulate(high + base)
    first = np.flatnonzero(np.append(True, (low + base)[1:] > reach[:-1]))
    high = (reach - base)[np.append(first[1:], len(keys)) - 1]
    keys, low = keys[first], low[first]
    part = keys % parts
    order = np.argsort(part, kind="stable")
    keys, low, high, part = keys[order], low[order], high[order], part[order]
    names, first = np.unique(part, return_index=True)
    return names, [press(b"".join((np.diff(keys[a:b], prepend=0).tobytes(), low[a:b].tobytes(), (high[a:b] - low[a:b]).tobytes())))
                   for a, b in zip(first, np.append(first, len(part))[1:], strict=True)]


def _map_batches(batches: Iterable[pa.RecordBatch], depth: int, buckets: int, classes: np.ndarray, ranges: int, texts_per_id: int = 1) -> Iterator[pa.RecordBatch]:
    """(key, text) rows -> (bucket, runs): each the packed runs of a chunk for a bucket, or for -1 - part the ranges of a part."""
    press = zstandard.ZstdCompressor(level=5).compress

    def packed(parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(p[2]) for p in parts], dtype=np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        data = np.frombuffer(b"".join(p[2] for p in parts) + bytes(8), dtype=np.uint8)
        at, windows, bucket = _runs(data, starts, ends, depth, buckets, classes)
        owner = np.searchsorted(ends, at, side="right")
        ids, offset = np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64)
        key, place = ids[owner], at - starts[owner] + offset[owner]
        left, copy = _combined(_run_keys(_words(data), at, windows, depth), key, place, texts_per_id)
        covered, rows = _range_parcels(key[copy], place[copy], place[copy] + windows[copy] + depth - 1, ranges)
        order = left[np.argsort(bucket[left], kind="stable")]
        at, windows, bucket, key, place = at[order], windows[order], bucket[order], key[order], place[order]
        names, first = np.unique(bucket, return_index=True)
        for a, b in zip(first, np.append(first, len(bucket))[1:], strict=True):
            step = np.diff(key[a:b], prepend=0)
            body = _gather(data, at[a:b], windows[a:b] + depth - 1)
            rows.append(press(b"".join((np.int64(b - a).tobytes(), step.tobytes(), place[a:b].tobytes(), windows[a:b].astype(np.int64).tobytes(), body.tobytes()))))
        return pa.RecordBatch.from_arrays([pa.array(np.append(-1 - covered, names), pa.int64()), pa.array(rows, pa.binary())], names=["bucket", "runs"])

    parts: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = (value.as_py() or "").encode()
            for start in range(0, max(0, len(text) - depth + 1), CHUNK):
                parts.append((key, start, text[start:start + CHUNK + depth - 1]))
                size += len(parts[-1][2])
                if size >= CHUNK:
                    yield packed(parts)
                    parts, size = [], 0
    if parts:
        yield packed(parts)


def repeated_ranges(keys: np.ndarray, place: np.ndarray, windows: np.ndarray, text: np.ndarray, depth: int, texts_per_id: int = 1) -> tuple[np.ndarray, ...]:
    """(key, first byte, end byte) of the windows of a bucket that also start in a smaller id."""
    if not len(keys):
        return (np.empty(0, np.int64),) * 3
    ids = keys // texts_per_id
    text = np.append(text, np.zeros(8, np.uint8))
    words = _words(text)
    lengths = windows + depth - 1
    text_at = np.cumsum(lengths) - lengths
    first_window = np.cumsum(windows) - windows
    at = np.repeat(text_at - first_window, windows) + np.arange(int(windows.sum()))

    def digit(positions: np.ndarray, low: int, high: int) -> np.ndarray:
        key = np.zeros(len(positions), dtype=np.uint64)
        for k in [*range(low, high - 8, 8), high - 8]:
            key = _mix(key, words[positions + k])
        return key

    head = digit(at, 0, HEAD)
    whole = _run_keys(words, text_at, windows, depth)
    smallest, _ = _group_minimum(whole, ids)
    copy = ids > smallest
    out = [(keys[copy], place[copy], place[copy] + windows[copy] + depth - 1)]
    # of each distinct run one with the smallest id goes on
    keep = np.flatnonzero(~copy)
    keep = keep[np.unique(whole[keep], return_index=True)[1]]
    again = np.flatnonzero(~copy)
    same = again[~np.isin(again, keep)]  # the smallest document holds the run more than once
    leader = {}
    if len(same):
        leader = dict(zip(whole[keep].tolist(), range(len(keep)), strict=True))
    sizes = windows[keep]
    total = int(sizes.sum())
    begin = np.cumsum(sizes) - sizes
    pick = np.repeat(first_window[keep] - begin, sizes) + np.arange(total)
    owner = np.repeat(np.arange(len(keep)), sizes)
    own = ids[keep][owner]
    covered = np.zeros(total, dtype=bool)
    _, shared = _group_minimum(head[pick], own)
    left = np.flatnonzero(shared)
    if len(left):
        key = _mix(head[pick][left], digit(at[pick[left]], HEAD - 8, depth))
        smallest, _ = _group_minimum(key, own[left])
        covered[left] = own[left] > smallest

    def ranges(mask: np.ndarray, run: np.ndarray, shift: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, ...]:
        hit = np.flatnonzero(mask)
        if not len(hit):
            return (np.empty(0, np.int64),) * 3
        new = np.append(True, (np.diff(hit) != 1) | (run[hit[1:]] != run[hit[:-1]]))
        a = hit[new]
        b = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
        return who[run[a]], shift[run[a]] + a, shift[run[a]] + b + depth

    out.append(ranges(covered, owner, place[keep] - begin, keys[keep]))
    for j in same:  # repeats inside one document: same windows are covered there
        i = leader[int(whole[j])]
        part = covered[begin[i]:begin[i] + sizes[i]]
        out.append(ranges(part, np.zeros(len(part), np.int64), place[j:j + 1], keys[j:j + 1]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _parts(keys: np.ndarray, place: np.ndarray, windows: np.ndarray, text: np.ndarray, depth: int, classes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The runs of a bucket in parts of about SORTED_WINDOWS windows, by their first digit again."""
    parts = -(-int(windows.sum()) // SORTED_WINDOWS)
    if parts <= 1:
        yield keys, place, windows, text
        return
    words = _words(np.append(text, np.zeros(8, np.uint8)))
    at = np.cumsum(windows + depth - 1) - (windows + depth - 1)
    low = _grams(words[at], classes)
    for k in range(1, depth - GRAM + 1):
        low = np.minimum(low, _grams(words[at + k], classes))
    part = ((low.astype(np.uint64) * _M2) >> np.uint64(32)) % np.uint64(parts)
    for k in range(parts):
        own = np.flatnonzero(part == k)
        if len(own):
            yield keys[own], place[own], windows[own], _gather(text, at[own], windows[own] + depth - 1)


def _parcels(parts: Iterable[int], blobs: list[bytes], kind: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())],
                                      names=["part", "kind", "parcel"])


def _reduce_batches(batches: Iterable[pa.RecordBatch], depth: int, parts: int, texts_per_id: int, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, sorted by bucket -> (part, kind 0, ranges). Holds the distinct runs of a bucket, and at most as much again."""
    unpress = zstandard.ZstdDecompressor().decompress
    columns: list[list[np.ndarray]] = [[], [], [], []]
    size, limit = 0, MERGED_WINDOWS

    def read(blob: bytes) -> int:
        data = unpress(blob)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        step, place, windows = np.frombuffer(data, np.int64, 3 * n, 8).reshape(3, n)
        for c, x in zip(columns, (np.cumsum(step), place, windows, np.frombuffer(data, np.uint8, offset=8 + 24 * n)), strict=True):
            c.append(x)
        return int(windows.sum())

    def merged() -> pa.RecordBatch:
        """Combine equal runs of what is read; the ranges of the others."""
        keys, place, windows, text = (np.concatenate(c) for c in columns)
        lengths = windows + depth - 1
        at = np.cumsum(lengths) - lengths
        left, copy = _combined(_run_keys(_words(np.append(text, np.zeros(8, np.uint8))), at, windows, depth), keys, place, texts_per_id)
        if len(left) < len(keys):
            text = _gather(text, at[left], lengths[left])
        columns[:] = [[keys[left]], [place[left]], [windows[left]], [text]]
        return _parcels(*_range_parcels(keys[copy], place[copy], place[copy] + lengths[copy], parts))

    def solved() -> pa.RecordBatch:
        found = [repeated_ranges(*some, depth, texts_per_id) for some in _parts(*(np.concatenate(c) for c in columns), depth, classes)]
        columns[:] = [[], [], [], []]
        return _parcels(*_range_parcels(*(np.concatenate(c) for c in zip(*found, strict=True)), parts))

    now = None
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket < 0:
                yield _parcels([-1 - bucket], [blob.as_py()])
                continue
            if bucket != now and columns[0]:
                yield solved()
                size, limit = 0, MERGED_WINDOWS
            now = bucket
            size += read(blob.as_py())
            if size > limit:
                yield merged()
                size = int(columns[2][0].sum())
                limit = max(MERGED_WINDOWS, 2 * size)
    if columns[0]:
        yield solved()


def _text_batches(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(key, text) rows -> (part, kind 1, texts): the packed texts of a chunk for a part."""
    press = zstandard.ZstdCompressor(level=3).compress

    def packed(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        by_part: dict[int, list[tuple[int, bytes]]] = {}
        for key, data in rows:
            by_part.setdefault(key % parts, []).append((key, data))
        blobs = []
        for own in by_part.values():
            head = np.array([len(own), *(k for k, _ in own), *(len(d) for _, d in own)], dtype=np.int64)
            blobs.append(press(head.tobytes() + b"".join(d for _, d in own)))
        return _parcels(list(by_part), blobs, 1)

    rows: list[tuple[int, bytes]] = []
    size = 0
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows.append((key, (value.as_py() or "").encode()))
            size += len(rows[-1][1])
            if size >= CHUNK:
                yield packed(rows)
                rows, size = [], 0
    if rows:
        yield packed(rows)


def _cut_batches(batches: Iterable[pa.RecordBatch], schema: pa.Schema, with_text: bool, texts_per_id: int) -> Iterator[pa.RecordBatch]:
    """Parcels sorted by (part, kind): the ranges of a part, then its texts -> result rows."""
    unpress = zstandard.ZstdDecompressor().decompress
    now, blobs = None, []
    table: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        for part, kind, blob in zip(*batch.columns, strict=True):
            if part.as_py() != now:
                now, blobs, table = part.as_py(), [], None
            if kind.as_py() == 0:
                blobs.append(blob.as_py())
                continue
            if table is None:
                split = [np.frombuffer(unpress(b), np.int64).reshape(3, -1) for b in blobs] or [np.empty((3, 0), np.int64)]
                keys = np.concatenate([np.cumsum(x[0]) for x in split])
                low, size = np.concatenate([x[1] for x in split]), np.concatenate([x[2] for x in split])
                order = np.lexsort((low, keys))
                table, blobs = (keys[order], low[order], low[order] + size[order]), []
            data = unpress(blob.as_py())
            n = int(np.frombuffer(data, np.int64, 1)[0])
            owners, lengths = np.frombuffer(data, np.int64, 2 * n, 8).reshape(2, n)
            first, last = np.searchsorted(table[0], owners, "left"), np.searchsorted(table[0], owners, "right")
            at, rows = 8 + 16 * n, []
            for key, length, a, b in zip(owners.tolist(), lengths.tolist(), first, last, strict=True):
                spans: list[list[int]] = []
                for low_, high_ in zip(table[1][a:b].tolist(), table[2][a:b].tolist(), strict=True):
                    if spans and low_ <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high_)
                    else:
                        spans.append([low_, high_])
                edges = [0, *(x for s in spans for x in s), length]
                kept = b"".join(data[at + i:at + j] for i, j in zip(edges[::2], edges[1::2], strict=True))
                at += length
                row = (key // texts_per_id, length, length - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                rows.append(row + (kept,) * with_text)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _ranks(ids: DataFrame) -> DataFrame:
    """(doc_id, rank): distinct ids numbered from 0 in their order, null last. Each task numbers a range of ids; the ranges' sizes give the offsets."""
    spark = ids.sparkSession
    order = [F.col("doc_id").isNull(), F.col("doc_id")]
    ranged = written(ids.repartitionByRange(shuffle_partitions(spark), *order).withColumn("range", F.spark_partition_id()), "ids")
    sizes = {r["range"]: r["count"] for r in ranged.groupBy("range").count().collect()}    # one number per range
    starts, total = [], 0
    for k in sorted(sizes):
        starts.append((k, total))
        total += sizes[k]
    start = spark.createDataFrame(starts, "range int, start long")
    number = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return written(ranged.withColumn("row", number).join(F.broadcast(start), "range").select("doc_id", (F.col("start") + F.col("row")).alias("rank")), "ranks")


def _numbers(texts: DataFrame) -> DataFrame:
    """(doc_id, h, number): the distinct texts of an id numbered from 0, in SPREAD parts, so that an id with many texts is not one group."""
    texts = texts.withColumn("part", F.pmod("h", F.lit(SPREAD)))
    sizes = texts.groupBy("doc_id", "part").agg(F.count(F.lit(1)).alias("n"))
    start = sizes.select(F.col("doc_id").alias("__id"), F.col("part").alias("__part"),
                         (F.sum("n").over(Window.partitionBy("doc_id").orderBy("part")) - F.col("n")).alias("start"))
    row = F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("h")) - 1
    both = texts.withColumn("row", row).join(start, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("part") == F.col("__part")))
    return both.select("doc_id", "h", (F.col("row") + F.col("start")).alias("number"))


def _keyed(rows: DataFrame) -> tuple[DataFrame, int, DataFrame | None]:
    """(key, text), the number of keys per id, and for keys that are not ids themselves (doc_id, rank).

    Ids that never come with two texts, and are not null, are keys. Otherwise
    the key is the id's rank times the largest number of texts of an id, plus
    the text's number; that product must stay below 2^63.
    """
    texts = rows.select("doc_id", F.xxhash64("text").alias("h")).distinct()
    found = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    most = found["most"] or 1
    if most == 1 and not found["nulls"]:
        return rows.select(F.col("doc_id").alias("key"), "text"), 1, None
    texts = written(texts, "texts")
    ranks = _ranks(texts.select("doc_id").distinct())
    of = _numbers(texts).join(ranks.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")))
    of = of.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), (F.col("rank") * most + F.col("number")).alias("key"))
    joined = rows.join(of, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__h")))
    return written(joined.select("key", "text"), "keyed"), most, ranks


def suffix_dedup(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes, if asked for).

    A byte goes if some ``depth``-byte string over it also starts in a
    document with a smaller id; strings are judged on the input. Null texts
    count as empty; texts shorter than ``depth`` keep all. A null id counts as
    larger than all others. Rows of one id, equal or not, never make each
    other's bytes go. Other columns are not read. An empty table gives an
    empty result. ``depth`` must be at least HEAD + 8.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = max(1, -(-size // bucket_bytes)), _prime(max(2, -(-size // PART_BYTES)))
    keyed, per_id, ranks = _keyed(rows)
    drawn = rows.where(F.octet_length("text") <= SAMPLE_BYTES).orderBy(F.xxhash64("doc_id"), "doc_id").select("text").limit(SAMPLE_TEXTS)
    classes = gram_classes(r["text"].encode() for r in drawn.toLocalIterator())
    runs = keyed.mapInArrow(lambda it: _map_batches(it, depth, buckets, classes, parts, per_id), "bucket long, runs binary")
    ranges = (runs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(lambda it: _reduce_batches(it, depth, parts, per_id, classes), "part long, kind int, parcel binary"))
    texts = keyed.mapInArrow(lambda it: _text_batches(it, parts), "part long, kind int, parcel binary")
    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
    schema = pa.schema(list(zip([x.split()[0] for x in names.split(", ")], types, strict=True)))
    out = (texts.unionByName(ranges).repartition(parts, "part").sortWithinPartitions("part", "kind")
           .mapInArrow(lambda it: _cut_batches(it, schema, with_text, per_id), names))
    if ranks is None:
        return out
    out = written(out.withColumnRenamed("doc_id", "rank"), "ranked")
    held = ranks.join(out.groupBy("rank").agg(F.count(F.lit(1)).alias("rows")), "rank")
    return join_small_or_hot(out, held, "rank", "rows").select("doc_id", *out.columns[1:])
