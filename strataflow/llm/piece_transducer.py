"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled to three transducers:

* the normaliser: a space becomes the space mark, and one is put before the text;
* the pieces: a trie whose accepting states emit a piece's id and return to the root;
* byte fallback: a character that no piece stands for emits its bytes' ids.

``compose(normaliser, union(pieces, fallback))`` is one transducer from raw
characters to ids, built once. Its composition with an input is a lattice of
positions; the encoding is its shortest path in the tropical semiring (weights add along a path, the least
sum wins). In a unigram model a piece weighs its negated score. In a BPE model
pieces weigh nothing and the weight lies on neighbours: a pair of pieces weighs
0 if merging their characters by rank leaves exactly that pair, else infinity.
A sequence of pieces is the outcome of the merges exactly when each pair of
neighbours is, so the one finite path is the BPE encoding. States of the
lattice are therefore (position, last piece); pair weights are worked out when
first met and kept.

No piece has the space mark after another character, so every path passes
between such a pair; the stretches between are composed one at a time, and a
cache of stretches stands before the composition.
"""

from __future__ import annotations

import codecs
import heapq
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import ship_code

#: Every byte that is no UTF-8 becomes U+FFFD.
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))

MARK = "▁"
#: Stretches and pairs whose results a worker keeps at most (about 250 and 100 bytes each); beyond that they are worked out again.
KEPT_STRETCHES, KEPT = 1_200_000, 400_000
INFINITY = float("inf")
_STRETCH = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
#: Labels of arcs: nothing read; any character without an arc of its own, repeated, or as the ids of its UTF-8 bytes.
EPSILON, OTHER, COPY, BYTES = "", "other", "copy", "bytes"
# Fixed values of the model format: kinds of models and pieces.
UNIGRAM, BPE = 1, 2
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Transducer:
    """States are numbers, 0 the start. ``arcs[state]``: (label read, output, weight, next state); a state may be left by several arcs.

    Labels are characters, EPSILON or OTHER; outputs are characters, ids, EPSILON, COPY or BYTES.
    """

    def __init__(self) -> None:
        self.arcs: list[list[tuple[str, str | int, float, int]]] = [[]]
        self.final = {0}

    def state(self) -> int:
        self.arcs.append([])
        return len(self.arcs) - 1

    def add(self, state: int, read: str, out: str | int, weight: float, to: int) -> None:
        self.arcs[state].append((read, out, weight, to))


def normaliser(prefix: bool) -> Transducer:
    """A mark before the text, spaces as marks, all else as it is."""
    t = Transducer()
    body = t.state() if prefix else 0
    if prefix:
        t.add(0, EPSILON, MARK, 0.0, body)
    t.add(body, " ", MARK, 0.0, body)
    t.add(body, OTHER, COPY, 0.0, body)
    t.final = {body}
    return t


def piece_trie(ids: dict[str, int], weight: Callable[[int], float]) -> Transducer:
    """A trie over the pieces; an accepting state emits its piece and returns to the root."""
    t = Transducer()
    at: dict[str, int] = {"": 0}
    for piece, i in ids.items():
        for k in range(1, len(piece) + 1):
            if piece[:k] not in at:
                at[piece[:k]] = t.state()
                t.add(at[piece[:k - 1]], piece[k - 1], EPSILON, 0.0, at[piece[:k]])
        t.add(at[piece], EPSILON, i, weight(i), 0)
    return t


def byte_fallback(weight: float) -> Transducer:
    """Any character as its bytes."""
    t = Transducer()
    t.add(0, OTHER, BYTES, weight, 0)
    return t


def union(pieces: Transducer, fallback: Transducer) -> Transducer:
    """Both from one start: the fallback's arcs for characters that no piece alone stands for."""
    t = Transducer()
    t.arcs = [list(a) for a in pieces.arcs]
    whole = {to for state, arcs in enumerate(t.arcs) for read, _, _, to in arcs if state == 0 and read != EPSILON and any(r == EPSILON for r, *_ in t.arcs[to])}
    for _, out, weight, _ in fallback.arcs[0]:
        for read, _, _, to in pieces.arcs[0]:
            if to not in whole:
                t.add(0, read, out, weight, 0)
        t.add(0, OTHER, out, weight, 0)
    return t


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that reads what ``first`` reads and writes what ``second`` makes of its output."""
    t, number, todo = Transducer(), {(0, 0): 0}, [(0, 0)]

    def to(pair: tuple[int, int]) -> int:
        if pair not in number:
            number[pair] = t.state()
            todo.append(pair)
        return number[pair]

    while todo:
        a, b = todo.pop()
        here = number[a, b]
        own = {read for read, *_ in first.arcs[a]}
        for read, out, weight, then in second.arcs[b]:
            if read == EPSILON:
                t.add(here, EPSILON, out, weight, to((a, then)))
        for read, middle, w1, after in first.arcs[a]:
            if middle == EPSILON:
                t.add(here, read, EPSILON, w1, to((after, b)))
                continue
            named = {r for r, *_ in second.arcs[b]}
            for label, out, w2, then in second.arcs[b]:
                if label == EPSILON:
                    continue
                if middle == COPY:       # reads any character but those with arcs of their own
                    if label not in own or label == OTHER:
                        t.add(here, label, out, w1 + w2, to((after, then)))
                elif label == middle or label == OTHER and middle not in named:
                    t.add(here, read, out if out != COPY else middle, w1 + w2, to((after, then)))
    t.final = {n for (a, b), n in number.items() if a in first.final and b in second.final}
    return t


def shortest(machine: Transducer, text: str, spell: Callable[[str], Sequence[int]]) -> tuple[float, tuple[int, ...]]:
    """Compose with an input and take the path of least weight (ties: the first found): (weight, ids). ``spell``: ids of a character's bytes."""
    best: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {(0, 0): (0.0, ())}
    queue = [(0, 0.0, 0, ())]
    found = (INFINITY, ())
    while queue:
        at, weight, state, ids = heapq.heappop(queue)
        if best.get((at, state), (INFINITY,))[0] < weight:
            continue
        if at == len(text) and state in machine.final and weight < found[0]:
            found = (weight, ids)
        named = {read for read, *_ in machine.arcs[state]}
        for read, out, more, then in machine.arcs[state]:
            if read == EPSILON:
                stop = at
            elif at < len(text) and (read == text[at] or read == OTHER and text[at] not in named):
                stop = at + 1
            else:
                continue
            made = ids + (() if out == EPSILON else tuple(spell(MARK if text[at] == " " else text[at])) if out == BYTES else (out,))
            if weight + more < best.get((stop, then), (INFINITY,))[0]:
                best[stop, then] = (weight + more, made)
                heapq.heappush(queue, (stop, weight + more, then, made))
    return found


def nested(machine: Transducer, root: int) -> dict:
    """The arcs between returns to the root as nested dicts: character -> node, "" -> the id of an accepting state. Byte fallback is left out."""
    nodes: dict[int, dict] = {root: {}}
    todo = [root]
    while todo:
        state = todo.pop()
        for read, made, _, then in machine.arcs[state]:
            if read == EPSILON:
                nodes[state][""] = made
            elif made != BYTES:
                if then not in nodes:
                    nodes[then] = {}
                    todo.append(then)
                nodes[state][read] = nodes[then]
    return nodes[root]


class Machine:
    """The compiled transducers of a model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models whose normaliser keeps characters and white space as they are")
        self.kind, self.prefix = model.trainer_spec.model_type, rules.add_dummy_prefix
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        self.text = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.score = [p.score for p in model.pieces]
        self.bytes_ = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes_[value], self.byte_of[i] = i, value
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type not in (NORMAL, USER_DEFINED, BYTE)}
        self.unknown = min(self.score) - 10.0
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has the space mark inside")
        self.ranks = {p: self.score[i] for p, i in self.ids.items()}
        self.simple = self.prefix and not any("\n" in p for p in self.ids)
        weigh = (lambda i: -self.score[i]) if self.kind == UNIGRAM else (lambda i: 0.0)
        self.transducer = compose(normaliser(self.prefix), union(piece_trie(self.ids, weigh), byte_fallback(-self.unknown if self.kind == UNIGRAM else 0.0)))
        # the state behind the mark before the text is where every piece starts, but for that mark
        self.trie = nested(self.transducer, self.body())
        # decoding: an ASCII byte is a character whatever stands beside it, higher bytes need their run
        self.shown = ["" if i in self.hidden else chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p for i, p in enumerate(self.text)]
        self.high = {i for i, b in self.byte_of.items() if b >= 128}
        self.pairs: dict[int, bool] = {}
        self.stretches: dict[str, tuple[int, ...]] = {}

    def body(self) -> int:
        """The state in which the normaliser is past its prefix and no piece has begun."""
        reads = {" ", MARK}
        return next(i for i, arcs in enumerate(self.transducer.arcs) if reads <= {r for r, *_ in arcs} and i in self.transducer.final)

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether a pair of neighbours has a finite weight; a = -1: whether b does after a border or a byte fallback.

        The characters of both are merged by rank, highest score first, leftmost of equals; no merge may cross the
        border, and nothing but the pair may be left."""
        if len(self.pairs) >= KEPT:
            self.pairs.clear()
        left = self.text[a] if a >= 0 else ""
        parts, border, score = list(left + self.text[b]), len(left), self.ranks.get
        scores = [score(x + y, -INFINITY) for x, y in zip(parts, parts[1:], strict=False)]
        apart = True
        while scores:
            best = max(scores)
            if best == -INFINITY:
                break
            i = scores.index(best)
            if i == border - 1:
                apart = False
                break
            border -= i < border
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], -INFINITY)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], -INFINITY)
        out = self.pairs[a << 20 | b] = apart and len(parts) == (2 if a >= 0 else 1)
        return out

    def spell(self, char: str) -> list[int]:
        """Ids of the bytes of a normalised character."""
        return [self.bytes_[b] for b in char.replace(" ", MARK).encode()]

    def arcs(self, stretch: str, at: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs from a position, longest first; piece -1 is byte fallback."""
        out: list[tuple[int, int]] = []
        node, j, n = self.trie.get(stretch[at]), at + 1, len(stretch)
        if node is None or "" not in node:
            out.append((j, -1))
        while node is not None:
            piece = node.get("")
            if piece is not None:
                out.append((j, piece))
            if j == n:
                break
            node = node.get(stretch[j])
            j += 1
        out.reverse()
        return out

    def shortest_path(self, stretch: str) -> tuple[int, ...]:
        """Compose with one stretch and take the shortest path."""
        return self.first_finite_path(stretch) if self.kind == BPE else self.least_path(stretch)

    def first_finite_path(self, stretch: str) -> tuple[int, ...]:
        """The shortest path where all finite weights are 0: best-first, so the first path that reaches the end, longest arcs first.

        A state (position, last piece) that leads nowhere is entered once."""
        n, pairs = len(stretch), self.pairs
        arcs: dict[int, list[tuple[int, int]]] = {}
        dead: set[tuple[int, int]] = set()
        path = [(0, -1, iter(self.arcs(stretch, 0)))]
        while True:
            at, last, more = path[-1]
            for state in more:
                end, piece = state
                if state in dead:
                    continue
                if piece >= 0:
                    apart = pairs.get(last << 20 | piece)
                    if apart is None:
                        apart = self.stay_apart(last, piece)
                    if not apart:
                        continue
                if end < n:
                    if end not in arcs:
                        arcs[end] = self.arcs(stretch, end)
                    path.append((end, piece, iter(arcs[end])))
                    break
                out: list[int] = []
                ends = [*(p[0] for p in path[1:]), n]
                for before, stop, piece in zip([0, *ends], ends, [*(p[1] for p in path[1:]), piece], strict=False):
                    if piece >= 0:
                        out.append(piece)
                    else:
                        out += self.spell(stretch[before:stop])
                return tuple(out)
            else:
                path.pop()
                dead.add((at, last))

    def least_path(self, stretch: str) -> tuple[int, ...]:
        """The path of least weight, position by position; the state is the position alone."""
        n = len(stretch)
        best: list[tuple] = [(0.0, -1, ())] + [(INFINITY, -1, ())] * n
        for i in range(n):
            weight = best[i][0]
            for j, piece in self.arcs(stretch, i):
                total = weight - (self.score[piece] if piece >= 0 else self.unknown)
                if total < best[j][0]:
                    best[j] = (total, i, (piece,) if piece >= 0 else tuple(self.spell(stretch[i])))
        back, i = [], n
        while i > 0:
            _, i, ids = best[i]
            back.append(ids)
        return tuple(x for ids in reversed(back) for x in ids)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text (null: empty)."""
        if not text:
            return []
        if self.simple and text[0] not in " \n" and text[-1] != " " and "  " not in text and " \n" not in text and MARK not in text:
            # the cache in front: words without their space, or with the line feed before them; every path passes there too, as no piece has one
            words = text.replace("\n", " \n").split(" ")
            found = list(map(self.stretches.get, words))
            if None in found:
                found = [self.stretch(w, w if w[0] == "\n" else " " + w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
            return list(chain.from_iterable(found))
        # the normaliser's prefix is what it makes of a space
        raw = " " + text if self.prefix else text
        return [i for s in _STRETCH.findall(raw) for i in (self.stretches.get(s) or self.stretch(s, s))]

    def stretch(self, name: str, stretch: str) -> tuple[int, ...]:
        """Ids of a stretch, kept under a name: itself, or without its one mark."""
        ids = self.stretches.get(name)
        if ids is None:
            ids = self.shortest_path(stretch)
            if len(stretch) <= 64:
                if len(self.stretches) >= KEPT_STRETCHES:
                    self.stretches.clear()
                self.stretches[name] = ids
        return ids

    def decode(self, ids: Sequence[int]) -> str:
        """The inverse: pieces to text, runs of bytes as UTF-8 (what is none becomes U+FFFD), marks to spaces, without the first."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
            return (text[1:] if self.prefix and text.startswith(MARK) else text).replace(MARK, " ")
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            value = self.byte_of.get(i)
            if value is not None:
                run.append(value)
                continue
            if run:
                parts.append(run.decode("utf-8", "each_byte"))
                run = bytearray()
            parts.append("" if i in self.hidden else self.text[i])
        if run:
            parts.append(run.decode("utf-8", "each_byte"))
        text = "".join(parts)
        if self.prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")


@lru_cache(maxsize=2)
def machine(path: str) -> Machine:
    return Machine(path)


def _encode_batches(batches: Iterable[pa.RecordBatch], path: str, kind: pa.DataType, with_ids: bool) -> Iterator[pa.RecordBatch]:
    m = machine(path)
    byte_ids = np.zeros(len(m.text), dtype=bool)
    byte_ids[list(m.byte_of)] = True
    names = ["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "decoded_crc32", "round_trip"] + ["ids"] * with_ids
    types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()] + [pa.list_(pa.int32())] * with_ids
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for start in range(0, batch.num_rows, 512):
            rows = []
            for key, value in zip(keys[start:start + 512], batch.column(1)[start:start + 512], strict=True):
                text = value.as_py() or ""
                ids = m.encode(text)
                again = m.decode(ids)
                data = np.array(ids, dtype="<u4")
                row = (key, len(ids), int(byte_ids[data].sum()), zlib.crc32(data.tobytes()), zlib.crc32(again.encode()), again == text)
                rows.append(row + ((ids,) if with_ids else ()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def encode(docs: DataFrame, model: str | None = None, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_ids, n_byte_ids, ids_crc32 (little-endian unsigned 32-bit ids), decoded_crc32 (UTF-8), round_trip, ids.

    round_trip says whether decoding gives the text again; a text that holds
    the space mark itself does not, as it becomes a space. Null and empty
    texts have no ids. Repeated rows get equal rows. Other columns are not
    read. An empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    path, kind = model or default_model(), docs.schema[id_col].dataType
    schema = (f"doc_id {kind.simpleString()}, n_ids long, n_byte_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
              + ", ids array<int>" * with_ids)
    arrow = to_arrow_type(kind)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda it: _encode_batches(it, path, arrow, with_ids), schema)


def decode(encoded: DataFrame, model: str | None = None, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """doc_id and the text of each row's ids (null ids: null)."""
    ship_code(encoded.sparkSession)
    path, kind = model or default_model(), encoded.schema[id_col].dataType
    arrow = to_arrow_type(kind)

    def batches(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            texts = [None if v.as_py() is None else machine(path).decode(v.as_py()) for v in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(batches, f"doc_id {kind.simpleString()}, text string")
