"""Phrase collocation mining with HAT-trie counting.

Each task counts its phrases in a burstable trie: a shallow trie over word ids
whose leaves are hash containers. A container that grows past BURST entries is
replaced by a node that deals them out by their next word. When the trie holds
LIMIT entries, whole subtrees, the largest first, leave it as sorted runs, cut
by prefix partition (a hash of language and first two words). The runs of a
partition are merged in one task, and phrases of at least ``least``
occurrences remain.

A phrase is frequent only if its parts are: words are counted first, then
pairs of frequent words, then phrases of 3 to ``longest`` words whose pairs
are all frequent. Tasks know the frequent parts by a filter of FILTER_BITS
bits; a false hit costs work, a miss cannot happen, so no phrase is lost.
Phrases are keyed by exact word ids in a task and by their bytes in the runs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import join_small_or_hot, ship_code, written

#: Occurrences of a candidate, words of the longest, phrases returned per language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Children of a trie node, entries that burst a container, entries of a task's tries.
FAN, BURST, LIMIT = 256, 4096, 600_000
#: Bits of a word id; a task starts over with the ids when they run out.
ID_BITS = 21
#: Bytes of text, and words of it, that are counted at a time; bytes of text whose phrases one partition merges.
CHUNK, STEP, BUCKET_BYTES = 1 << 20, 1 << 18, 8 << 20
#: Bits of the filter of frequent phrases.
FILTER_BITS = 26

_U = np.uint64
_Q = 0xD1B54A32D192ED03
_MASK = MAX_IDS = (1 << ID_BITS) - 1
#: A-Z as a-z, every end of a piece as a line feed, tab as space.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 10 + b" ")


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of all texts, a line feed at the end of each piece."""
    data = b"\n".join([*texts, b""]).translate(_PLAIN).replace(b"\n", b" \n ")
    return list(filter(None, data.split(b" ")))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def phrase_hash(lang: str, hashes: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases, from the arrays of their first, second, ... words' hashes (0: no word)."""
    total = np.full(len(hashes[0]), xxhash.xxh3_64_intdigest(lang.encode()), dtype=np.uint64)
    for h in hashes:
        total = total * _U(_Q) + h
    return mix(total)


class WordIds(dict):
    """Word -> id from 1 in order of appearance; the end of a piece is 0. ``hashes`` by id."""

    def __init__(self):
        super().__init__({b"\n": 0})
        self._hashes = np.zeros(1, np.uint64)
        self._words: pa.Array | None = None

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def hashes(self) -> np.ndarray:
        if len(self._hashes) < len(self):
            new = list(self)[len(self._hashes):]
            self._hashes = np.append(self._hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in new], dtype=np.uint64))
        return self._hashes

    def words(self) -> pa.Array:
        if self._words is None or len(self._words) < len(self):
            self._words = pa.array(list(self), pa.binary())
        return self._words


class HatTrie:
    """Counts of phrases of one language. A code holds word ids as digits, the first word lowest.

    ``root`` has FAN slots; a slot is a container (dict code -> count) or, once
    burst, a list of FAN slots for the next word. Words share a slot by their
    id's low bits, so containers hold whole codes.
    """

    def __init__(self):
        self.root: list = [{} for _ in range(FAN)]
        self.sizes = [0] * FAN

    def add(self, codes: list[int], counts: list[int]) -> None:
        root, sizes, low = self.root, self.sizes, FAN - 1
        for code, count in zip(codes, counts, strict=True):
            parent, slot, shift = root, code & low, ID_BITS
            box = root[slot]
            while type(box) is list:
                parent, slot = box, (code >> shift) & low
                box, shift = parent[slot], shift + ID_BITS
            if code in box:
                box[code] += count
                continue
            box[code] = count
            sizes[code & low] += 1
            if len(box) > BURST and shift < ID_BITS * LONGEST:
                parent[slot] = self._burst(box, shift)

    @staticmethod
    def _burst(box: dict, shift: int) -> list:
        out: list = [{} for _ in range(FAN)]
        for code, count in box.items():
            out[(code >> shift) & (FAN - 1)][code] = count
        return out

    def cut(self, slot: int) -> tuple[list[int], list[int]]:
        """Codes and counts of a whole subtree, which leaves the trie."""
        codes, counts, todo = [], [], [self.root[slot]]
        while todo:
            box = todo.pop()
            if type(box) is list:
                todo += box
            else:
                codes += box.keys()
                counts += box.values()
        self.root[slot], self.sizes[slot] = {}, 0
        return codes, counts


class PhraseCounter:
    """Counts phrases of ``shortest`` to ``longest`` words whose parts pass ``known``; ``emit`` gets (lang, bucket, run)."""

    def __init__(self, shortest: int, longest: int, buckets: int, known: np.ndarray | None, emit: Callable[[str, int, bytes], None]):
        self.shortest, self.longest, self.buckets, self.known, self.emit = shortest, longest, buckets, known, emit
        self.part = min(2, shortest - 1)   # words of the parts that the filter knows
        self.ids, self.tries = WordIds(), defaultdict(HatTrie)
        self.press = zstandard.ZstdCompressor(level=1).compress

    def _frequent(self, lang: str, hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Whether a part of ``self.part`` words that may be frequent starts here."""
        n = len(word) - self.part + 1
        hit = np.ones(n, bool)
        for i in range(self.part):
            hit &= word[i:i + n]
        value = phrase_hash(lang, [hashes[i:i + n] for i in range(self.part)])[hit] >> _U(64 - FILTER_BITS)
        hit[hit] = (self.known[(value >> _U(6)).astype(np.int64)] >> (value & _U(63))) & _U(1) == 1
        return hit

    def feed(self, lang: str, texts: list[bytes]) -> None:
        words = words_of(texts)
        for start in range(0, len(words), STEP):
            if len(self.ids) + STEP + LONGEST > MAX_IDS:
                self.flush()
                self.ids = WordIds()
            part = words[start:start + STEP + self.longest - 1]
            ids = np.fromiter(map(self.ids.__getitem__, part), np.int64, len(part))
            self._count(lang, np.append(ids, np.zeros(self.longest, np.int64)), min(STEP, len(words) - start))
        self.spill()

    def _count(self, lang: str, ids: np.ndarray, starts: int) -> None:
        word, trie = ids > 0, self.tries[lang]
        frequent = self._frequent(lang, self.ids.hashes()[ids], word) if self.part else None
        for k in range(self.shortest, self.longest + 1):
            ok = word[:starts].copy()
            for i in range(k - self.part + 1) if self.part else ():
                ok &= frequent[i:i + starts]
            at = np.flatnonzero(ok)
            low = sum(ids[at + i] << (ID_BITS * i) for i in range(min(k, 3)))
            if k <= 3:
                codes, counts = np.unique(low, return_counts=True)
                trie.add(codes.tolist(), counts.tolist())
                continue
            high = sum(ids[at + i] << (ID_BITS * (i - 3)) for i in range(3, k))
            order = np.lexsort((low, high))
            low, high = low[order], high[order]
            first = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[:len(low)])
            codes = [a | b << (3 * ID_BITS) for a, b in zip(low[first].tolist(), high[first].tolist(), strict=True)]
            trie.add(codes, np.diff(np.append(first, len(low))).tolist())

    def spill(self) -> None:
        """Largest subtrees leave until the tries are half empty, if they are full; those of a language leave as one set of runs."""
        size = sum(sum(t.sizes) for t in self.tries.values())
        if size <= LIMIT:
            return
        leaving = defaultdict(list)
        for n, lang, slot in sorted(((n, lang, slot) for lang, t in self.tries.items() for slot, n in enumerate(t.sizes)), reverse=True):
            if size <= LIMIT // 2:
                break
            leaving[lang].append(slot)
            size -= n
        for lang, slots in leaving.items():
            self._leave(lang, slots)

    def flush(self) -> None:
        for lang in self.tries:
            self._leave(lang, range(FAN))

    def _leave(self, lang: str, slots: Iterable[int]) -> None:
        codes, counts = [], []
        for slot in slots:
            more = self.tries[lang].cut(slot)
            codes += more[0]
            counts += more[1]
        self._run(lang, codes, counts)

    def _run(self, lang: str, codes: list[int], counts: list[int]) -> None:
        """Sorted runs of what leaves a trie, one per prefix partition."""
        if not codes:
            return
        bits, n = 3 * ID_BITS, np.array(counts, np.int64)
        if self.longest <= 3:
            low, high = np.array(codes, np.int64), np.zeros(len(codes), np.int64)
        else:
            low, high = np.array([c & ((1 << bits) - 1) for c in codes], np.int64), np.array([c >> bits for c in codes], np.int64)
        digit = [(x >> (ID_BITS * i)) & _MASK for x, m in ((low, 3), (high, 2)) for i in range(m)][:self.longest]
        words = self.ids.words()
        column = [words.take(pa.array(d, mask=d == 0)) for d in digit]        # no word: null, left out of the phrase
        phrases = pc.binary_join_element_wise(*column, pa.scalar(b" ", pa.binary()), null_handling="skip")
        hashes = self.ids.hashes()
        first_two = [hashes[digit[0]], hashes[digit[1]] if len(digit) > 1 else np.zeros(len(n), np.uint64)]
        bucket = ((phrase_hash(lang, first_two) >> _U(32)) * _U(self.buckets) >> _U(32)).astype(np.int64)
        order = pc.sort_indices(phrases).to_numpy()
        order = order[np.argsort(bucket[order], kind="stable")]
        phrases, n, bucket = phrases.take(pa.array(order)), n[order], bucket[order]
        ends = np.frombuffer(phrases.buffers()[1], np.int32, len(n) + 1, 4 * phrases.offset)
        data = memoryview(phrases.buffers()[2])
        names, first = np.unique(bucket, return_index=True)
        for name, a, b in zip(names.tolist(), first, np.append(first, len(bucket))[1:], strict=True):
            # number of phrases, their counts, their lengths, their bytes
            self.emit(lang, name, self.press(b"".join((np.int64(b - a).tobytes(), n[a:b].tobytes(), np.diff(ends[a:b + 1]).tobytes(), data[ends[a]:ends[b]]))))


def merged(runs: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(phrases in byte order, counts) of sorted runs."""
    unpress = zstandard.ZstdDecompressor().decompress
    phrases, counts = [], []
    for run in map(unpress, runs):
        n = int(np.frombuffer(run, np.int64, 1)[0])
        counts.append(np.frombuffer(run, np.int64, n, 8))
        ends = np.append(0, np.cumsum(np.frombuffer(run, np.int32, n, 8 * (n + 1)))).astype(np.int32)
        phrases.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(run[8 * (n + 1) + 4 * n:])]))
    held = pa.concat_arrays(phrases)
    order = pc.sort_indices(held)
    counts, held = np.concatenate(counts)[order.to_numpy()], held.take(order)
    first = np.flatnonzero(np.append(True, pc.not_equal(held[1:], held[:-1]).to_numpy(zero_copy_only=False)))
    return held.take(pa.array(first)), np.add.reduceat(counts, first)


# ---- Spark

def _run_batches(batches: Iterable[pa.RecordBatch], shortest: int, longest: int, buckets: int, known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows -> (bucket, lang, run)."""
    out: list[tuple[int, str, bytes]] = []
    counter = PhraseCounter(shortest, longest, buckets, known, lambda lang, bucket, run: out.append((bucket, lang, run)))

    def ready() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.binary()), strict=True)], names=["bucket", "lang", "run"])

    waiting, held = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            waiting[lang].append(text)
            held += len(text) + 1
            if held >= CHUNK:
                for key, texts in waiting.items():
                    counter.feed(key, texts)
                waiting, held = defaultdict(list), 0
                if out:
                    yield ready()
    for key, texts in waiting.items():
        counter.feed(key, texts)
    counter.flush()
    yield ready()


def _merge_batches(batches: Iterable[pa.RecordBatch], least: int, totals: bool) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, lang, run) sorted by bucket and lang -> (lang, phrase, f) of frequent phrases and, with phrase null, all occurrences."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for (_, lang), group in groupby(rows, key=lambda r: r[:2]):
        phrases, counts = merged([r[2] for r in group])
        keep = counts >= least
        found, f = [p.decode() for p in phrases.filter(pa.array(keep)).to_pylist()], counts[keep].tolist()
        if totals:
            found, f = [*found, None], [*f, int(counts.sum())]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string()), pa.array(f, pa.int64())], names=["lang", "phrase", "f"])


def _filter(counts: DataFrame) -> np.ndarray:
    """Bits of the hashes of all phrases: FILTER_BITS bits, however many there are."""
    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.split(b" ") for w in batch.column(1).cast(pa.binary()).to_pylist()]
            width = max(map(len, words), default=1)
            hashes = [np.array([xxhash.xxh3_64_intdigest(w[i]) for w in words], dtype=np.uint64) for i in range(width)]   # one length in a table
            for lang in set(batch.column(0).to_pylist()):
                at = np.flatnonzero(np.array(batch.column(0).to_pylist()) == lang)
                value = phrase_hash(lang, [h[at] for h in hashes]) >> _U(64 - FILTER_BITS)
                yield pa.RecordBatch.from_arrays([pa.array((value >> _U(6)).astype(np.int64)), pa.array((_U(1) << (value & _U(63))).view(np.int64))], names=["at", "bits"])

    rows = counts.where("phrase is not null").select("lang", "phrase").mapInArrow(bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang",
                  bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(lang, phrase, f): all phrases of 1 to ``longest`` words with f >= least occurrences inside pieces, and per lang parts of the number of all words with phrase null."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    buckets = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes))
    levels, known = [], None
    for shortest, top in ((1, 1), (2, 2), (3, longest)):
        if top < shortest or longest < shortest:
            break
        known = _filter(levels[-1]) if levels else None
        runs = rows.mapInArrow(lambda it, s=shortest, t=top, k=known: _run_batches(it, s, t, buckets, k), "bucket long, lang string, run binary")
        counts = (runs.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang")
                  .mapInArrow(lambda it, one=shortest == 1: _merge_batches(it, least, one), "lang string, phrase string, f long"))
        levels.append(written(counts, f"phrases-{shortest}"))
    out = levels[0]
    for more in levels[1:]:
        out = out.union(more)
    return out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per lang its ``top`` phrases by score: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at . , ; : ! ? and line ends into pieces
    and those at spaces and tabs into words. n: all words of the lang, f: all
    occurrences inside pieces. Candidates have 2 to ``longest`` words and a = f
    >= least; their score is the least floor(1000 a n / (l r)) over the cuts
    into a first part (l times) and a rest (r times), ties to the shortest
    first part, in decimal arithmetic of 38 digits. Candidates inside a longer
    one that is as frequent are dropped. Order: score, a (both descending),
    phrase (bytes).

    A null text is empty, a null lang is ``und``. Repeated rows count as often
    as they are there. Other columns are not read. No row without candidates,
    as from an empty table.
    """
    counts = phrase_counts(docs, least, longest, text_col, lang_col, bucket_bytes)
    size = counts.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    f = counts.where("phrase is not null")
    # a longer phrase can be as frequent only if one with one word more is
    words = F.split("phrase", " ")
    many = f.where(F.instr("phrase", " ") > 0).withColumn("words", words)
    inner = many.where("size(words) > 2").select("lang", "f", F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("words"))
    longer = inner.groupBy("lang", F.array_join("words", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = many.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < f").drop("longer")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("first"),
                       F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("rest"))
    part = lambda name, count: f.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    whole = size.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("held")), "lang")
    best = join_small_or_hot(cuts.select("lang", "phrase", "a", "k", "l", "r"), whole, "lang", "held")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("p div q")
    best = best.withColumn("p", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("q", exact("l") * exact("r")).withColumn("score", score)
    low = best.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    low = low.select("lang", "phrase", *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = low.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
