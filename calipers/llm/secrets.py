"""Secret scan: fixed patterns, and the guess cost of values that stand where a credential is named.

The guess cost of a value is the least number of guesses (as a logarithm) over all ways to
cut it into words, dates, repeats, keyboard walks and brute-force spans: a shortest path
over the positions of the value. Values that are cheap to guess (`token: string`) are talk;
dear ones are secrets, whatever their form. Words are ranked by the number of documents they stand in.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calipers.llm.common import by_size, stored, text_of
from calipers.llm.runs import runs_of
from calipers.runtime import ship

# The patterns of the base kinds and the least lengths of their matches.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Names that announce a credential, and what may stand between the name and the value.
CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|login|auth(?:orization)?|bearer"""
    r"""|(?:private|access|client|account|storage)[_-]?(?:key|secret)|pin)["']?(?:\x20*[:=]\x20*|\x20+is\x20+)["']?"""
    r"""([^\s"'<>]{6,})""", re.ASCII,
)
#: One of these is in every text that ASSIGN or CONTEXT can match.
HINTS = ("pass", "pwd", "secret", "token", "api", "credential", "login", "auth", "bearer", "key", "pin")
#: Values that need this many guesses (as a power of ten) count as secrets.
LEAST_COST = 9.0
#: So many words are learnt from the documents at most, each from so many documents at least.
LEARNT_WORDS, LEARNT_FROM = 20_000, 3

# Words tried first, most frequent first.
WORDS = """
    password passwd pass secret token login admin user username root test example sample demo string value none null
    true false required optional changeme change default welcome letmein master dragon monkey qwerty abc iloveyou
    sunshine princess football baseball shadow hello hunter superman batman trustno freedom whatever computer internet
    server client account access private public system database service api key auth bearer code number name email
    phone address the and for you your this that with from have not are was will can please enter here new old my
    our his her their one two three four five six seven eight nine ten love baby angel money summer winter spring
    autumn monday friday january february march april may june july august september october november december
    red green blue black white orange yellow purple dog cat tiger lion eagle star sun moon sky fire water
    expired invalid missing forgotten reset generated encrypted hidden unknown placeholder
""".split()
# The rows of a keyboard; each lower row is shifted to the right by half a key.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_RANK = {word: rank for rank, word in reversed(list(enumerate(WORDS, 1)))}
_PLAIN = str.maketrans("0134578@$!", "oleastbasi")
_DATES = tuple(map(re.compile, (
    r"(?:19|20)\d\d([./_-]?)[01]\d\1[0-3]\d", r"[0-3]\d[01]\d(?:19|20)\d\d",
    r"\d{1,2}([./_-])\d{1,2}\1(?:\d{4}|\d\d)", r"(?:19|20)\d\d",
)))
_CLASS_SIZE = ((re.compile(r"[0-9]"), 10), (re.compile(r"[a-z]"), 26), (re.compile(r"[A-Z]"), 26), (re.compile(r"."), 33))


@lru_cache(maxsize=1)
def keyboard_neighbours() -> dict[str, frozenset[str]]:
    place = {c: (x + y / 2, y) for y, row in enumerate(KEYBOARD) for x, c in enumerate(row)}
    return {
        c: frozenset(o for o, (u, v) in place.items() if o != c and abs(u - x) <= 1 and abs(v - y) <= 1)
        for c, (x, y) in place.items()
    }


def _walk_cost(length: int, turns: int) -> float:
    keys = keyboard_neighbours()
    degree = sum(map(len, keys.values())) / len(keys)
    return math.log10(len(keys)) + math.log10(length) + turns * math.log10(degree)


def _word_cost(part: str, low: str, plain: str, ranks: dict[str, int]) -> float | None:
    """The cost of `part` as a word; low: in small letters; plain: with letters for digits and signs."""
    rank = min(ranks.get(low, math.inf), ranks.get(plain, math.inf))
    if rank == math.inf:
        return None
    swaps = sum(c.isupper() for c in part[1:]) + sum(a != b for a, b in zip(low, plain, strict=True)) * (low not in ranks)
    return math.log10(rank) + (0.3 if part[:1].isupper() else 0.0) + 0.5 * swaps


def _walk_ends(low: str) -> list[int]:
    """For each character, the last one of the keyboard walk that begins with it."""
    keys, ends = keyboard_neighbours(), list(range(len(low)))
    for i in range(len(low) - 2, -1, -1):
        if low[i + 1] in keys.get(low[i], ()):
            ends[i] = ends[i + 1]
    return ends


def _sequence_ends(value: str) -> list[int]:
    """For each character, the last one of the sequence of neighbouring code points, up or down, that begins with it."""
    step = [0, *(ord(b) - ord(a) for a, b in itertools.pairwise(value)), 0]
    ends = list(range(len(value)))
    for i in range(len(value) - 2, -1, -1):
        if step[i + 1] in (1, -1):
            ends[i] = ends[i + 1] if step[i + 2] == step[i + 1] else i + 1
    return ends


def _repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, unit) of all stretches that repeat a unit at least twice and can't be extended; the least unit of each."""
    letters = np.frombuffer(value.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    _, found = runs_of(letters, np.array([len(letters)]), least=2)
    return list(zip(found.start.tolist(), found.end.tolist(), found.period.tolist(), strict=True))


def guess_cost(value: str, ranks: dict[str, int] = _RANK, enough: float = math.inf) -> float:
    """The least power of ten of guesses over all cuts of the value into known kinds of parts.

    A repeat costs its unit and the logarithm of the times; the unit has no smaller one, or is no longer than the
    longest word. Costs of `enough` or more need not be exact. Where a place is reached best by a repeat, walk or
    sequence, the same one is not begun anew there: its longer part from the same start is never dearer.
    """
    n = len(value)
    low = value.lower()
    low = low if len(low) == n else value
    plain = low.translate(_PLAIN)
    best = [0.0] + [math.inf] * n
    by: list[tuple | None] = [None] * (n + 1)  # the stretch that the best cut reaches a place by
    single = [math.log10(next(size for kind, size in _CLASS_SIZE if kind.match(c))) if c != "\n" else 1.5 for c in value]
    walks, sequences = _walk_ends(low), _sequence_ends(value)
    longest = max(map(len, ranks), default=0)
    repeats = _repeats(value) if n > 2 else []
    units: dict[str, float] = {}

    def reach(j: int, cost: float, stretch: tuple | None = None) -> None:
        if cost < best[j]:
            best[j], by[j] = cost, stretch

    for i in range(n):
        here = best[i]
        if here >= enough:
            continue
        reach(i + 1, here + single[i])
        for j in range(i + 3, min(n, i + longest) + 1):
            if (cost := _word_cost(value[i:j], low[i:j], plain[i:j], ranks)) is not None:
                reach(j, here + cost)
        for date in filter(None, (kind.match(value, i) for kind in _DATES)):
            days = 120 if len(date[0]) == 4 else 365 * 120
            reach(date.end(), here + math.log10(days))
        for start, end, least in repeats:
            for unit in range(least, max(least, min(longest, (end - i) // 2)) + 1, least):
                if start > i or i + 2 * unit > end:
                    continue
                part = value[i: i + unit]
                if part not in units:
                    units[part] = guess_cost(part, ranks, enough)
                before = by[i]
                if before and before[:3] == ("repeat", start, end) and unit % before[3] == 0 and (
                    units[part] >= math.log10((1 + unit / before[3]) / 2)
                ):
                    continue
                stretch = ("repeat", start, end, unit)
                for times in range(2, (end - i) // unit + 1):
                    if times * unit >= 3:
                        reach(i + times * unit, here + units[part] + math.log10(times), stretch)
        if walks[i] >= i + 2 and by[i] != ("walk", walks[i]):
            turns, step = 0, None
            for j in range(i + 1, walks[i] + 1):
                turn = ord(low[j]) - ord(low[j - 1])
                turns += step is not None and turn != step
                step = turn
                if j >= i + 2:
                    reach(j + 1, here + _walk_cost(j + 1 - i, turns), ("walk", walks[i]))
        if sequences[i] >= i + 2 and by[i] != ("sequence", sequences[i]):
            for j in range(i + 3, sequences[i] + 2):
                reach(j, here + 1.5 + math.log10(j - i), ("sequence", sequences[i]))
    return best[n]


def is_dear(value: str, ranks: dict[str, int] = _RANK) -> bool:
    """Whether the value takes LEAST_COST or more."""
    return guess_cost(value, ranks, LEAST_COST) >= LEAST_COST


def base_spans(text: str, named: bool, access: bool, long_hex: bool) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) of the base kinds."""
    out = []
    if named:
        out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if access:
        out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if long_hex:
        out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    return sorted(out)


def guessed_spans(text: str, known: list[tuple[int, int, str, int]], ranks: dict[str, int]) -> list[tuple[int, int, str, int]]:
    """Values after a credential's name that are dear to guess and do not lie inside a known span."""
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        end -= len(m[1]) - len(m[1].rstrip(".,;:!?)]}"))
        if end - start >= 6 and not any(a <= start and end <= b for a, _, _, b in known) and is_dear(text[start:end], ranks):
            out.append((start, 3, "guess", end))
    return out


def with_long_hex(texts: list[str]) -> np.ndarray:
    """Which texts hold HEX_LEAST lower-case hex digits in a row."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n" * HEX_LEAST, dtype=np.uint8)
    run = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102))
    reach = 1
    while reach < HEX_LEAST:
        step = min(reach, HEX_LEAST - reach)
        run = run[: len(run) - step] & run[step:]
        reach += step
    ends = np.cumsum([len(p) + 1 for p in parts])
    out = np.zeros(len(texts), dtype=bool)
    out[np.unique(np.searchsorted(ends, np.flatnonzero(run), side="right"))] = True
    return out


def spans_of(texts: list[str], ranks: dict[str, int] = _RANK) -> list[list[tuple[int, int, str, int]]]:
    """All spans of every text, base kinds and guessed ones, by start and kind."""
    out = []
    for text, long_hex in zip(texts, with_long_hex(texts), strict=True):
        low = text.lower()
        named = any(h in low for h in HINTS)
        base = base_spans(text, named, "AKIA" in text, bool(long_hex))
        out.append(sorted(base + (guessed_spans(text, base, ranks) if named else [])))
    return out


def _told(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def word_ranks(docs: DataFrame, most: int = LEARNT_WORDS, least: int = LEARNT_FROM) -> dict[str, int]:
    """Ranks of the known words, and of the words of letters that stand in most documents.

    They stand in `least` documents at least, and in so many that `most` words do at most.
    """
    words = F.array_distinct(F.split(F.lower(text_of(F.col("text"))), r"[^\p{L}]+", -1))
    counts = docs.select(F.explode(words).alias("word")).where("length(word) between 3 and 40").groupBy("word").count()
    counts = stored(counts.where(F.col("count") >= least), "words")
    spread = Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.groupBy("count").agg(F.count(F.lit(1)).alias("words")).withColumn("words", F.sum("words").over(spread))
    cut = reached.where(F.col("words") <= most).agg(F.min("count")).first()[0]
    learnt = counts.where(F.col("count") >= cut).collect() if cut else []
    ranks = dict(_RANK)
    for rank, row in enumerate(sorted(learnt, key=lambda r: (-r["count"], r["word"])), 1):
        ranks[row["word"]] = min(rank, ranks.get(row["word"], rank))
    return ranks


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess of every row of docs; docs: doc_id, text.

    Spans are code points of the whole text, end exclusive. Guessed values may overlap base spans, but do not lie inside
    one. Null text counts as empty; a text without spans has the digest of the empty string. Repeated rows get
    equal rows. Texts and values of any length are read whole. No rows: no rows.
    """
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            found = spans_of(part.column("text").to_pylist(), ranks.value)
            base = [[s for s in spans if s[1] < 3] for spans in found]
            count = lambda kind, spans: pa.array([sum(s[2] == kind for s in x) for x in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), count("assign", base), count("access", base), count("hex", base),
                pa.array([hashlib.sha256(_told(spans).encode()).hexdigest() for spans in base], pa.string()),
                pa.array([_told(spans) for spans in found], pa.string()), count("guess", found),
            ], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
    )
