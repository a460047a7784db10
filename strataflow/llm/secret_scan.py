"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain. An inverted index holds, for each trigram that
some query reads, the documents that contain it; intersecting and uniting
postings gives each rule's candidates, and only those are searched with the
expression. A rule without mandatory trigrams searches every document.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import without, written

#: Strings that one stretch of an expression may stand for before it counts as arbitrary.
MOST_STRINGS = 64
#: Trigrams of each set of a query that are looked up: those of the rarest letters, which this order gives from common to rare.
INDEXED, LETTERS = 2, "etaoinshrdlcumwfgypbvkjxqz"
#: Elements of an array that a fold takes at a time, and levels of such folds; characters of a text that a fold rebuilds at a time.
FOLD, LEVELS, PIECE = 64, 3, 4096
#: Candidates are broadcast up to this many (24 bytes each), and joined by a shuffle beyond it.
BROADCAST_ROWS = 250_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


_KEYWORDS = "(password|passwd|secret|token|api_?key)"
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in _KEYWORDS)
# The base rules; runs that are too short are left out of the expression where that finds the same matches.
BASE = (
    Rule("assign", _EITHER + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further public token formats.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
_BREAK = r"""(?:[\s>|#*"'+,]|\\[nr])"""
_PEM = MORE[0].pattern
# What is taken out of a text: as above, but a private key from its header through the END line or, where none follows
# before the next marker, through the lines that look like a key. Possessive loops, which Java runs without recursion.
REDACTED = BASE + (
    Rule("pem", _PEM + r"(?:(?:[^-]++|-(?!----))*+" + _PEM.replace("BEGIN", "END") + "|"
         + rf"(?:{_BREAK}*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_BREAK}++[A-Za-z0-9+/=]{{16,}}+)*+"
         + rf"""(?:{_BREAK}++[A-Za-z0-9+/=]++(?![^"'\\\r\n]))?+)"""),
) + MORE[1:]

#: A query in disjunctive form: any of the sets of trigrams; the empty set holds for every document.
Query = frozenset[frozenset[str]]
_ALL: Query = frozenset([frozenset()])


def _simplified(query: Iterable[frozenset[str]]) -> Query:
    sets = set(query)
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _of_strings(strings: set[str]) -> Query:
    return _simplified(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def rarest(query: Query) -> Query:
    """A query that holds wherever ``query`` does, from the INDEXED rarest trigrams of each of its sets."""
    rarity = lambda g: (-sum(LETTERS.find(c) if c in LETTERS else len(LETTERS) for c in g), g)
    return _simplified(frozenset(sorted(s, key=rarity)[:INDEXED]) for s in query)


def _and(a: Query, b: Query) -> Query:
    both = _simplified(x | y for x in a for y in b)
    return both if len(both) <= MOST_STRINGS else a


def _strings(items) -> set[str] | None:
    """All strings (lower case) that a parsed stretch stands for; None if too many."""
    out = {""}
    for code, arg in items:
        if code is op.LITERAL:
            own: set[str] | None = {chr(arg).lower()}
        elif code is op.IN:
            own = set()
            for kind, x in arg:
                if kind is op.LITERAL:
                    own.add(chr(x).lower())
                elif kind is op.RANGE and x[1] - x[0] < 8:
                    own |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
            if len(own) > 8:
                return None
        elif code is op.SUBPATTERN:
            own = _strings(arg[3])
        elif code is op.BRANCH:
            parts = [_strings(b) for b in arg[1]]
            own = None if None in parts else set().union(*parts)
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[1] == 1:
            own = _strings(arg[2])
            own = own if own is None or arg[0] else own | {""}
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] == arg[1]:
            own = _strings(list(arg[2]) * int(arg[0]))
        else:
            own = None
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, own)}
    return out


def _query(items) -> Query:
    out, stretch = _ALL, {""}

    def flush() -> None:
        nonlocal out, stretch
        out, stretch = _and(out, _of_strings(stretch)), {""}

    for item in items:
        own = _strings([item])
        if own is not None and len(stretch) * len(own) <= MOST_STRINGS:
            stretch = {a + b for a, b in product(stretch, own)}
            continue
        code, arg = item
        if own is None and code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] >= 1:
            first = _strings(arg[2])  # one round is certain, and next to what stands before
            if first is not None and len(stretch) * len(first) <= MOST_STRINGS:
                stretch = {a + b for a, b in product(stretch, first)}
                flush()
                continue
        flush()
        if own is not None:
            stretch = own
        elif code is op.SUBPATTERN:
            out = _and(out, _query(arg[3]))
        elif code is op.BRANCH:
            out = _and(out, _simplified(x for b in arg[1] for x in _query(b)))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] >= 1:
            out = _and(out, _query(arg[2]))
    flush()
    return out


def trigram_query(pattern: str) -> Query:
    """What every match of ``pattern`` contains, in lower case."""
    return _query(list(parser.parse(pattern)))


def postings(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): the inverted index of the given trigrams over rows (key, text)."""
    low = F.lower("text")
    found = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(low, g))
    return keyed.select(F.explode(found).alias("gram"), "key")


def candidates(keyed: DataFrame, rules: Iterable[Rule]) -> DataFrame | None:
    """(key, kinds): documents that satisfy the query of a rule, and the kinds of those rules; None if no rule has a query."""
    queries = {r.kind: rarest(q) for r in rules if (q := trigram_query(r.pattern)) != _ALL}
    grams = sorted({g for q in queries.values() for s in q for g in s})
    if not grams:
        return None
    index = written(postings(keyed, grams), "postings")
    holds = {g: F.max(F.col("gram") == g).alias(f"g{i}") for i, g in enumerate(grams)}
    per_key = index.groupBy("key").agg(*holds.values())
    number = {g: i for i, g in enumerate(grams)}
    every = lambda s: [F.col(f"g{number[g]}") for g in sorted(s)]

    def all_of(columns: list[Column]) -> Column:
        out = columns[0]
        for c in columns[1:]:
            out = out & c
        return out

    def any_of(columns: list[Column]) -> Column:
        out = columns[0]
        for c in columns[1:]:
            out = out | c
        return out

    kinds = F.array_compact(F.array(*[F.when(any_of([all_of(every(s)) for s in sorted(q, key=sorted)]), F.lit(k)) for k, q in queries.items()]))
    return written(per_key.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0), "candidates")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _blocks(values: Column) -> Column:
    """An array as an array of its blocks of FOLD elements."""
    some = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / FOLD).cast("int")), lambda i: F.slice(values, i * FOLD + 1, FOLD))
    return F.when(F.size(values) > 0, some).otherwise(F.array().cast("array<array<int>>"))


def before(values: Column, both: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """For each of the integers ``both`` (sum, greatest) folded over all before it, from 0.

    A fold copies what it has, so it runs over blocks only; the blocks' totals
    are folded in the same way. The work is in proportion to the array up to
    FOLD**levels blocks.
    """
    def step(acc: Column, x: Column) -> Column:
        return F.struct(both(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    fold = lambda block: F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)
    if levels == 0:
        return fold(values)["out"]

    def joined(local: Column) -> Column:
        start = before(F.transform(local, lambda x: x["at"]), both, levels - 1)
        return F.flatten(F.zip_with(local, start, lambda x, o: F.transform(x["out"], lambda v: both(o, v))))

    return _let(values, lambda v: _let(F.transform(_blocks(v), fold), joined))


def match_spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost non-overlapping matches as (start, order, end), in characters; the text between matches gives the places."""
    matches, between = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    judged = matches if not rule.group else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    steps = F.transform(F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match"), judged.alias("judged")),
                        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("size"), (F.length(x["judged"]) >= rule.least).alias("ok")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def placed(steps: Column) -> Column:
        at = before(F.transform(steps, lambda x: x["gap"] + x["size"]), lambda a, b: a + b)
        spans = F.zip_with(steps, at, lambda x, o: F.struct((o + x["gap"]).alias("start"), F.lit(order).alias("kind"), (o + x["gap"] + x["size"]).alias("end"), x["ok"].alias("ok")))
        return F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    return F.when(text.rlike(rule.pattern), _let(steps, placed)).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: an array of (start, kind number, end) in characters, end exclusive, by start and kind.

    Null texts count as empty. An input column named spans is replaced. Rows
    that repeat an id and a text get equal spans. Whole texts are searched. An
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), text)
    found = candidates(docs.select(key.alias("key"), text.alias("text")), rules)
    rows = without(docs, ("spans", "__key", "__kinds")).withColumn("__key", key)
    if found is not None:
        found = found.select(F.col("key").alias("__key"), F.col("kinds").alias("__kinds"))
        rows = rows.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "__key", "left")
    parts = []
    for i, r in enumerate(rules):
        spans = match_spans(text, r, i)
        if trigram_query(r.pattern) != _ALL:
            spans = F.when(F.array_contains("__kinds", r.kind), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
        parts.append(spans)
    return rows.withColumn("spans", F.array_sort(F.concat(*parts))).drop("__key", "__kinds")


def span_list(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """The text with every span (overlapping ones joined) replaced by a mark; the spans column goes. Scan by the rules REDACTED for it.

    A null text stays null, a text without spans as it is, an empty table
    empty; rows that repeat are treated alike. A text is rebuilt in pieces of
    PIECE characters, each from the spans that reach into it, found by way of
    pieces FOLD times as long: the work grows hardly faster than text and
    spans.
    """
    text = F.col(text_col)

    def piece(chars: Column, base: Column, spans: Column) -> Column:
        """The piece of the text from ``base`` on, from the spans that reach into it."""
        stop = base + F.length(chars)

        def step(acc: Column, s: Column) -> Column:
            kept = F.substring(chars, acc["at"] - base + 1, F.greatest(F.lit(0), F.least(s["start"], stop) - acc["at"]))
            more = F.concat(acc["out"], kept, F.when(s["fresh"] & (s["start"] >= base), F.lit(mark)).otherwise(F.lit("")))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

        rest = lambda acc: F.concat(acc["out"], F.substring(chars, acc["at"] - base + 1, F.greatest(F.lit(0), stop - acc["at"])))
        return F.aggregate(spans, F.struct(base.alias("at"), F.lit("").alias("out")), step, rest)

    def cut(chars: Column, base: Column, spans: Column, sizes: list[int]) -> Column:
        pieces = F.regexp_extract_all(chars, F.lit(f"(?s).{{1,{sizes[0]}}}"), F.lit(0))

        def one(own: Column, i: Column) -> Column:
            start = base + i * sizes[0]
            mine = F.filter(spans, lambda s: (s["start"] < start + sizes[0]) & (s["end"] > start))
            return _let(mine, lambda m: piece(own, start, m) if len(sizes) == 1 else F.when(F.size(m) > 0, cut(own, start, m, sizes[1:])).otherwise(own))

        return F.array_join(F.transform(pieces, one), "")

    # a span is fresh if no earlier one reaches to its start
    reach = before(F.transform("spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    spans = F.zip_with("spans", reach, lambda s, r: F.struct(s["start"].alias("start"), s["end"].alias("end"), (s["start"] >= r).alias("fresh")))
    whole = _let(spans, lambda x: cut(text, F.lit(0), x, [PIECE * FOLD, PIECE]))
    return scanned.withColumn(text_col, F.when(F.size("spans") > 0, whole).otherwise(text)).drop("spans")
