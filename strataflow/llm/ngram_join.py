"""N-gram Jaccard join with PartEnum signatures.

A document's set is its distinct word shingles (64-bit hashes). Two sets link
when their Jaccard similarity reaches num / den (0.8). Sizes of linked sets
lie within that ratio, and their symmetric difference is at most
k = floor((a + b) * (den - num) / (den + num)).

Sets are dealt to size bands; sets of a band share one random partition of the
feature domain into first-level parts, each of N2 second-level parts. Linked
sets agree on all but k parts, so for some first-level part they agree on a
subset of N2 - K2 of its second-level parts. Every such subset of every
first-level part gives one signature, the hash of what the set holds there:
linked sets share a signature. With more parts than needed, a set may leave
out its least telling signatures: if linked sets agree in t signatures, each
can drop its t - 1 last ones in any order that both use. The order puts
signatures of common shingles (by a bounded sample) and small ones last. Only
speed depends on it.

Sets that share a signature are compared in full, by ``set_links``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .set_links import BLOCK, DEN, NUM, Prune, links_of_lists
from .tables import join_small_or_hot, ship_code, written

#: Words in a shingle.
WORDS = 5
#: Second-level parts, and how many of them a signature leaves out.
N2, K2 = 2, 1
#: First-level parts are this many times the least number that works, so that signatures can be left out.
SPARE = 1.5
#: Ratio of the sizes in a band.
BAND = 2.4414
#: Bytes of text that a map task works on at a time, and whose signatures one bucket holds on average.
CHUNK, BUCKET_BYTES = 1 << 20, 16 << 20
#: Links that a task contracts at a time.
LINK_BLOCK = 1 << 20
#: Numbers of 64 bits in a sketch.
SKETCH = 32
#: Sets sampled to find common shingles, how many must hold one, and the bits of the table of them.
SAMPLE_SETS, SAMPLE_COMMON, TABLE_BITS = 4096, 3, 22
#: Bits of the filter by which texts are looked up again.
FILTER_BITS = 23
_U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.int64).view(np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of _P and of its inverse, grown when a longer text comes."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(n, _P), _powers(n, pow(_P, -1, 2**64))
        return cls.up, cls.down


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle) of the distinct shingles, sorted by both."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(begin) == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    word = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    doc = np.searchsorted(ends, begin, side="right")
    count = np.bincount(doc, minlength=len(texts))
    total = np.zeros(max(0, len(word) - words + 1), dtype=np.uint64)
    for i in range(words):
        total = total * _U(_Q) + word[i:i + len(total)]
    whole = doc[:len(total)] == doc[words - 1:]
    at, value = doc[:len(total)][whole], mix(total[whole])
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = [sum(int(word[f + i]) * pow(_Q, i + 1, 2**64) for i in range(int(count[d]))) + int(count[d])
                 for d, f in zip(short, first, strict=True)]
        extra = mix(np.array([x % 2**64 for x in extra], dtype=np.uint64))
        at, value = np.append(at, short), np.append(value, extra)
    order = np.argsort(value)
    at, value = at[order], value[order]
    order = np.argsort(at.astype(np.uint16) if len(texts) < 1 << 16 else at, kind="stable")
    at, value = at[order], value[order]
    if len(at):
        new = np.append(True, (at[1:] != at[:-1]) | (value[1:] != value[:-1]))
        at, value = at[new], value[new]
    return at, value


def set_ids(at: np.ndarray, value: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(set id, size) of each document: equal sets have equal ids."""
    size = np.bincount(at, minlength=docs)
    total = np.zeros(docs, dtype=np.uint64)
    np.add.at(total, at, mix(value ^ _U(_Q)))
    return mix(total + size.astype(np.uint64)), size


def largest_difference(a: np.ndarray | int, b: np.ndarray | int):
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def bands(largest: int) -> list[tuple[int, int]]:
    """(smallest, largest) sizes: bands that follow each other, and one across each border between two."""
    out, low = [], 4
    while low <= largest:
        high = max(low + 1, int(low * BAND))
        out.append((low, high - 1))
        out.append((-(-high * NUM // DEN), (high - 1) * DEN // NUM))
        low = high
    return out


def _parts(high: int) -> int:
    """First-level parts of a band whose largest size is ``high``."""
    k = int(largest_difference(high, high))
    return max(1, int(SPARE * (k // (K2 + 1) + 1) + 0.5))


def signatures(at: np.ndarray, value: np.ndarray, size: np.ndarray, common: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signature, document number) arrays of the kept signatures, band by band (first the plain bands, then those across borders)."""
    docs = len(size)
    subsets = list(combinations(range(N2), N2 - K2))
    bits = len(common).bit_length() - 1
    usual = common[(value >> _U(64 - bits)).astype(np.int64)] if bits else np.zeros(len(value), bool)
    all_bands = bands(int(size.max(initial=0)))
    for kind in (0, 1):
        low = np.array([b[0] for b in all_bands[kind::2]] or [1 << 60])
        high = np.array([b[1] for b in all_bands[kind::2]] or [0])
        band = np.searchsorted(low, size, side="right") - 1
        inside = (band >= 0) & (size <= high[np.maximum(band, 0)])
        parts = np.array([_parts(int(h)) for h in high])
        n1 = np.where(inside, parts[np.maximum(band, 0)], 0)
        first = np.cumsum(n1) - n1
        use = inside[at]
        doc, x = at[use], value[use]
        seed = mix(x + (band[doc].astype(np.uint64) * _U(2) + _U(kind + 1)) * _U(_P))
        part = ((seed >> _U(32)) * (n1[doc] * N2).astype(np.uint64) >> _U(32)).astype(np.int64)
        slot = first[doc] * N2 + part
        total = int(n1.sum()) * N2
        held, rare, sums = np.bincount(slot, minlength=total), np.bincount(slot, weights=~usual[use], minlength=total).astype(np.int64), np.zeros(total, np.uint64)
        np.add.at(sums, slot, mix(x ^ _U(_P)))
        cell = lambda a: a.reshape(-1, N2)
        owner = np.repeat(np.arange(docs), n1)
        index = np.arange(len(owner)) - first[owner]
        sig, rank = [], []
        for j, subset in enumerate(subsets):
            s = mix(cell(sums)[:, subset[0]] * _U(3) + _U(subset[0]))
            for c in subset[1:]:
                s = mix(s + cell(sums)[:, c] * _U(3) + _U(c))
            tag = (band[owner].astype(np.uint64) * _U(2) + _U(kind)) * _U(len(subsets)) + _U(j)
            sig.append(mix(s ^ mix(index.astype(np.uint64) * _U(_Q) + tag)))
            rank.append((15 - np.minimum(15, cell(rare)[:, list(subset)].sum(axis=1))) * 16 + 15 - np.minimum(15, cell(held)[:, list(subset)].sum(axis=1)))
        who, sig, rank = np.tile(owner, len(subsets)), np.concatenate(sig), np.concatenate(rank)
        # order within a document: by rank, then by signature
        order = np.argsort((rank.astype(np.uint64) << _U(56)) | (sig >> _U(8)))
        order = order[np.argsort(who[order].astype(np.uint16) if docs < 1 << 16 else who[order], kind="stable")]
        k = largest_difference(size, np.minimum(size * DEN // NUM, np.where(inside, high[np.maximum(band, 0)], 0)))
        agree = np.maximum(n1 - k // (K2 + 1), comb(N2, N2 - K2) * n1 - k * comb(N2 - 1, N2 - K2 - 1))
        keep = np.where(inside, comb(N2, N2 - K2) * n1 - np.maximum(agree, 1) + 1, 0)
        start = np.cumsum(n1 * len(subsets)) - n1 * len(subsets)
        chosen = order[np.arange(len(order)) - start[who[order]] < keep[who[order]]]
        yield sig[chosen], who[chosen]


def sketches(at: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
    """Parity of the shingles in each of 64 * SKETCH cells, as SKETCH numbers per document.

    The sketches of two sets differ in no more bits than the sets differ in shingles.
    """
    cell = (mix(value ^ _U(0xA5A5A5A5)) >> _U(64 - (64 * SKETCH).bit_length() + 1)).astype(np.int64)
    out = np.zeros(docs * SKETCH, dtype=np.uint64)
    np.bitwise_xor.at(out, at * SKETCH + (cell >> 6), _U(1) << (cell & 63).astype(np.uint64))
    return out.reshape(docs, SKETCH).view(np.int64)


# ---- Spark

def _chunks(batches: Iterable[pa.RecordBatch], ids: bool = True) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, texts) of about CHUNK bytes each."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys.append(key)
            texts.append((value.as_py() or "").encode())
            size += len(texts[-1])
            if size >= CHUNK or len(texts) >= 60_000:
                yield keys, texts
                keys, texts, size = [], [], 0
    if texts:
        yield keys, texts


def _set_batches(batches: Iterable[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for keys, texts in _chunks(batches):
        at, value = shingle_sets(texts)
        ids, size = set_ids(at, value, len(texts))
        sketch = pa.FixedSizeListArray.from_arrays(pa.array(sketches(at, value, len(texts)).reshape(-1)), SKETCH).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(ids.view(np.int64)), pa.array(size.astype(np.int64)), sketch],
                                         names=["doc_id", "set_id", "n", "sketch"])


def _signature_batches(batches: Iterable[pa.RecordBatch], buckets: int, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, text) rows -> (bucket, packed signatures of a chunk): of equal sets in a chunk one speaks for all."""
    press = zstandard.ZstdCompressor(level=1).compress
    for _, texts in _chunks(batches):
        at, value = shingle_sets(texts)
        ids, size = set_ids(at, value, len(texts))
        one = np.zeros(len(texts), dtype=bool)
        one[np.unique(ids, return_index=True)[1]] = True
        mine = one[at]
        found = list(signatures(at[mine], value[mine], np.where(one, size, 0), common))
        sig, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        bucket = (mix(sig) >> _U(32)) * _U(buckets) >> _U(32)
        order = np.lexsort((doc, bucket))
        sig, doc, bucket = sig[order], doc[order], bucket[order].astype(np.int64)
        names, first = np.unique(bucket, return_index=True)
        rows = []
        for a, b in zip(first, np.append(first, len(bucket))[1:], strict=True):
            rows.append(press(b"".join((np.int64(b - a).tobytes(), sig[a:b].tobytes(), ids[doc[a:b]].tobytes()))))
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(rows, pa.binary())], names=["bucket", "signatures"])


def _group_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> (gid, set_id): the sets of each signature that has several; gid names the list of sets, so equal lists are one."""
    unpress = zstandard.ZstdDecompressor().decompress

    def solved(blobs: list[bytes]) -> pa.RecordBatch:
        split = [np.frombuffer(unpress(b), np.uint64) for b in blobs]
        sig = np.concatenate([x[1:1 + int(x[0])] for x in split])
        ids = np.concatenate([x[1 + int(x[0]):] for x in split])
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        new = np.append(True, (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1]))
        sig, ids = sig[new], ids[new]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(first, len(sig)))
        gid = mix(np.add.reduceat(mix(ids), first) + count.astype(np.uint64))
        keep = count > 1
        keep[keep] = np.isin(np.flatnonzero(keep), np.flatnonzero(keep)[np.unique(gid[keep], return_index=True)[1]])
        rows = np.repeat(keep, count)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(gid, count)[rows].view(np.int64)), pa.array(ids[rows].view(np.int64))], names=["gid", "set_id"])

    now, blobs = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != now and blobs:
                yield solved(blobs)
                blobs = []
            now = bucket
            blobs.append(blob.as_py())
    if blobs:
        yield solved(blobs)


def sketches_of(held: list[np.ndarray]) -> np.ndarray:
    return sketches(np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate(held), len(held))


def may_link(i: int, n: np.ndarray, sketch: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Those of ``other`` whose sketches leave a link with i possible."""
    if not len(other):
        return other
    differ = np.bitwise_count((sketch[other] ^ sketch[i]).view(np.uint64)).sum(axis=1)
    return other[differ <= largest_difference(n[other], n[i])]


def _held_batches(batches: Iterable[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(hash of the id, text) rows that may be wanted -> (set_id, shingles)."""
    mask = _U(len(wanted) * 64 - 1)

    def maybe() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) & mask
            hit = (wanted[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1)
            yield batch.filter(pa.array(hit == 1))

    for _, texts in _chunks(maybe()):
        at, value = shingle_sets(texts)
        ids, _ = set_ids(at, value, len(texts))
        start = np.searchsorted(at, np.arange(len(texts) + 1))
        one = np.unique(ids, return_index=True)[1]
        yield pa.RecordBatch.from_arrays([pa.array(ids[one].view(np.int64)), pa.array([value[start[i]:start[i + 1]].tobytes() for i in one], pa.binary())],
                                         names=["set_id", "shingles"])


def _contracted_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links (a, b) of a partition -> (node, label): the smallest node that it reaches inside the partition."""
    pairs = [np.column_stack([c.to_numpy() for c in b.columns[:2]]) for b in batches if b.num_rows]
    if not pairs:
        return
    pairs = np.concatenate(pairs)
    nodes, at = np.unique(pairs, return_inverse=True)
    x, y = at.reshape(pairs.shape).T
    label = np.arange(len(nodes))
    while True:
        low, after = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(after, label[x], low)
        np.minimum.at(after, label[y], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    for i in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i:i + 100_000]), pa.array(nodes[label[i:i + 100_000]])], names=["node", "label"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): label is the smallest node reachable.

    Blocks of about LINK_BLOCK links are contracted to stars, each in its
    task; what several blocks leave goes on by label propagation with pointer
    jumping, written every round.
    """
    links = links.select("a", "b")
    blocks = -(-links.count() // LINK_BLOCK)
    stars = links.repartition(max(1, blocks)).mapInArrow(_contracted_batches, "node long, label long")
    if blocks <= 1:
        return written(stars, "labels")
    links = stars.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = lower.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        after = written(lower.join(jump, "to", "left").select("node", F.least("to", F.coalesce("beyond", "to")).alias("label"), "was"), "labels")
        if after.where("label <> was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def _common_shingles(docs: DataFrame, sets: DataFrame) -> np.ndarray:
    """Table over the leading bits of a shingle: True for those that several sets of a bounded sample hold."""
    few = sets.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).orderBy("set_id").limit(SAMPLE_SETS)

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(texts)[1].view(np.int64))], names=["shingle"])

    texts = docs.join(F.broadcast(few.select("doc_id")), "doc_id").select("doc_id", "text").repartition(16)
    often = (texts.mapInArrow(shingles, "shingle long").groupBy("shingle").count().where(f"count >= {SAMPLE_COMMON}")
             .orderBy(F.desc("count")).limit(1 << (TABLE_BITS - 3)).toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[(often >> _U(64 - TABLE_BITS)).astype(np.int64)] = True
    return table


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the hashes in column ``h``, in FILTER_BITS bits however many there are: false hits are possible, misses are not."""
    bit = F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    rows = keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((h & {(1 << FILTER_BITS) - 1}) & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    Words are runs of other than space and control white space, A-Z lower-cased;
    a set is the distinct 5-word shingles, or the whole sequence of a shorter
    text. Null and empty texts have no set, link with nothing and are their own
    component. Equal sets link. A null id is never the smallest while another
    id is reachable. Repeated rows get equal answers. Other columns are not
    read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    sets = written(rows.mapInArrow(lambda it: _set_batches(it, arrow), f"doc_id {kind}, set_id long, n long, sketch array<long>"), "sets")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    common = _common_shingles(rows, sets)
    lists = (rows.mapInArrow(lambda it: _signature_batches(it, buckets, common), "bucket long, signatures binary")
             .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_group_batches, "gid long, set_id long"))
    members = written(lists.distinct(), "members")
    # grouped before the join: a set that many documents share is one row by then
    profiles = sets.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    involved = written(profiles.join(members.select("set_id").distinct(), "set_id", "left_semi"), "involved")
    wanted = _bitmap(involved.select(F.xxhash64("doc_id").alias("h")))
    held = (rows.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(lambda it: _held_batches(it, wanted), "set_id long, shingles binary")
            .join(involved.select("set_id"), "set_id", "left_semi").groupBy("set_id").agg(F.first("shingles").alias("shingles")))
    held = written(held, "held")
    differ = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    prune = Prune(differ <= F.floor((F.col("n_a") + F.col("n_b")) * (DEN - NUM) / (DEN + NUM)), may_link)
    links = links_of_lists(members, involved.drop("doc_id"), held, prune, sketches_of, components, BLOCK)
    labels = components(links).withColumnRenamed("node", "set_id")
    per_set = sets.groupBy("set_id").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows"))
    named = per_set.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    lowest = named.groupBy("label").agg(F.min("low").alias("component_id"))
    answer = named.join(lowest, "label").select("set_id", "component_id", "rows")
    out = join_small_or_hot(sets.drop("sketch"), answer, "set_id", "rows")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every component the row with the smallest id and, of equal ids, the smallest hash of the text; all columns.

    A null id counts as larger than all others. Rows without words are their
    own component and all stay. Of rows that repeat an id and a text with
    words one stays, an arbitrary one where they differ in other columns.
    """
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        groups = jaccard_groups(docs, id_col, text_col)
        leave = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id"))
        return docs.join(leave, F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(F.col(id_col).isNull().alias("later"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    groups = written(jaccard_groups(docs.select(row.alias("row"), text.alias("text")), "row", "text"), "row-groups")
    own = lambda x: x.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.hash").alias("__hash"))
    at = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash"))
    kept = docs.withColumn("__key", F.xxhash64(text)).join(own(groups.where("doc_id <> component_id")).distinct(), at, "left_anti")
    again = own(groups.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").count().where("count > 1"))
    if again.isEmpty():
        return kept.drop("__key")
    once = kept.join(again, at, "left_semi").dropDuplicates([id_col, "__key"])
    return kept.join(again, at, "left_anti").unionByName(once).drop("__key")
