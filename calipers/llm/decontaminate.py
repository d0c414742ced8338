"""Benchmark decontamination by CGK embedding and bit-sampling LSH, with exact edit verification.

Texts are sequences of words. The CGK walk reads a sequence with a random one-bit rule per
step and word: it writes the present word and then stays or goes on. Two sequences at a
small edit distance fall back into step soon after each edit, so their walks agree in many
places: edit distance becomes Hamming distance. Sampling a few places of the walk gives a
hash key; the keys of all benchmark items are looked up for windows of the items' sizes
starting at every word of every document. Keys are drawn again until simulated edits reach
the target recall; where they do not, and for very long items, every stretch that the word
pairs below leave is verified instead. Whatever meets is verified by the exact edit distance.

An edit breaks two word pairs at most, so a window within d edits of an item of n words
keeps n - 1 - 2 d pairs of the item. Windows with fewer pairs that occur in the benchmark
are passed over before the walk; none that could be verified is lost by that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import packed, stored, text_of
from calipers.llm.words import groups_of, mixed, words_of
from calipers.runtime import ship

SIMILARITY = 0.8
#: Items of fewer words allow no edit and are found by equality. They are too common to drop a document for.
LEAST_WORDS = 5
SAMPLES, WALKS = 3, 4
#: Samplings of a walk at most, and words of items at most that are walked; beyond, stretches are verified directly.
MOST_SAMPLINGS, LONGEST_WALKED = 256, 1_000
#: Benchmark characters and items that go to the executors at once; a larger benchmark is searched in several passes.
BLOCK_CHARS, BLOCK_ITEMS = 8_000_000, 20_000

_STEP_SALTS = mixed(np.arange(1, 100_000, dtype=np.uint64)) | np.uint64(1)


def edits_allowed(n: int) -> int:
    return math.floor(n * (1 - SIMILARITY) + 1e-9)


@dataclass
class SizeClass:
    """Items of `low` to `high` words: sampled places of the walks, and the items' keys under every sampling."""

    low: int
    high: int
    items: list[int]  # numbers in the block
    places: np.ndarray  # (walk, sampling, SAMPLES) steps, ascending
    keys: np.ndarray  # (sampling of all walks, item), each row ascending
    order: np.ndarray  # positions in `items` of the sorted keys
    slots: np.ndarray  # which low bits occur among the keys of a sampling

    exact = False

    def meets(self, row: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the values equal a key of this sampling, with the items of that key."""
        hit = np.flatnonzero(self.slots[row, _low(values, self.slots.shape[1])])
        a = np.searchsorted(self.keys[row], values[hit], side="left")
        times = np.searchsorted(self.keys[row], values[hit], side="right") - a
        which = np.repeat(np.arange(len(hit)), times)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        return hit[which], self.order[row, a[which] + offset]


@dataclass
class ExactClass:
    """Items of `low` to `high` words that are verified wherever enough of their word pairs occur."""

    low: int
    high: int
    items: list[int]  # numbers in the block
    pairs: np.ndarray  # word pairs of the items, ascending
    holders: np.ndarray  # position in `items` of each

    exact = True

    def hits(self, words: np.ndarray) -> np.ndarray:
        """For every item, how many of the word pairs of `words` it holds."""
        mine = _pairs(words)[:-1]
        a = np.searchsorted(self.pairs, mine, side="left")
        times = np.searchsorted(self.pairs, mine, side="right") - a
        offset = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        return np.bincount(self.holders[np.repeat(a, times) + offset], minlength=len(self.items))


def exact_class(low: int, high: int, items: list[int], words: list[np.ndarray]) -> ExactClass:
    each = [np.unique(_pairs(words[i])[:-1]) for i in items]
    pairs, holders = np.concatenate(each), np.repeat(np.arange(len(items)), [len(x) for x in each])
    order = np.argsort(pairs, kind="stable")
    return ExactClass(low, high, items, pairs[order], holders[order])


def _low(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys & np.uint64(slots - 1)).astype(np.int64)


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys (all samplings, start) of the CGK walks that begin at `starts` of `words` and read a pad from `ends` on."""
    walks, samplings, _ = places.shape
    keys = np.zeros((walks * samplings, len(starts)), dtype=np.uint64)
    for walk in range(walks):
        at = starts.astype(np.int64)
        mine = places[walk]
        used = {int(p): np.flatnonzero((mine == p).any(axis=1)) + walk * samplings for p in np.unique(mine)}
        for step in range(int(mine.max()) + 1):
            inside = at < ends
            seen = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
            if step in used:
                value = mixed(seen + np.uint64(step))
                for row in used[step]:
                    keys[row] = keys[row] * np.uint64(0x9E3779B97F4A7C15) + value
            at += ((seen * _STEP_SALTS[walk * 20_011 + step]) >> np.uint64(63)).astype(np.int64) & inside
    return keys


def _edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = words.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out))) if out else 0
        if kind == 0 and out:
            out[at] = int(rng.integers(1, 2**62))
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, int(rng.integers(1, 2**62)))
    return np.array(out, dtype=np.uint64)


def _joined(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bounds = np.cumsum([0, *(len(s) for s in sequences)])
    return np.concatenate(sequences), bounds[:-1], bounds[1:]


def size_class(low: int, high: int, items: list[int], words: list[np.ndarray], target: float) -> SizeClass | ExactClass:
    """Draw samplings until items changed by as many edits as allowed are met with the target recall, or give up walking."""
    if high > LONGEST_WALKED:
        return exact_class(low, high, items, words)
    rng = np.random.default_rng(low)
    steps = max(1, math.ceil(1.5 * low))
    own = _joined([words[i] for i in items])
    probe = [items[k % len(items)] for k in range(max(200, min(2 * len(items), 400)))]
    changed = _joined([_edited(words[i], edits_allowed(len(words[i])), rng) for i in probe])
    base = _joined([words[i] for i in probe])
    each = 4
    while True:
        places = np.sort(rng.integers(0, steps, (WALKS, each, SAMPLES)), axis=2)
        met = (walk_keys(*base, places) == walk_keys(*changed, places)).any(axis=0).mean()
        if met >= target:
            break
        if each >= MOST_SAMPLINGS:
            return exact_class(low, high, items, words)
        each *= 2
    keys = walk_keys(*own, places)
    order = np.argsort(keys, axis=1, kind="stable")
    keys = np.take_along_axis(keys, order, axis=1)
    slots = np.zeros((len(keys), 1 << max(12, (16 * len(items)).bit_length())), dtype=bool)
    for row, values in enumerate(keys):
        slots[row, _low(values, slots.shape[1])] = True
    return SizeClass(low, high, items, places, keys, order, slots)


@dataclass
class Index:
    ids: list
    words: list[np.ndarray]
    classes: list[SizeClass | ExactClass]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: hashes of whole items, ascending, and their numbers
    known: np.ndarray  # slots of word pairs that occur in the items

    def pairs_known(self, words: np.ndarray) -> np.ndarray:
        """For every word, whether the benchmark may hold it together with the next word."""
        return self.known[_pair_slots(words, len(self.known))]


def _pairs(words: np.ndarray) -> np.ndarray:
    following = np.concatenate([words[1:], np.zeros(min(1, len(words)), dtype=np.uint64)])
    return mixed(words + following * np.uint64(0x9E3779B97F4A7C15))


def _pair_slots(words: np.ndarray, slots: int) -> np.ndarray:
    return _low(_pairs(words), slots)


def _sequences(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for every run of n words."""
    out = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = mixed(out + words[k: k + len(out)])
    return out


def build_index(ids: list, texts: list[str], target: float, least_words: int = 1) -> Index:
    """Items of fewer than `least_words` words are left out."""
    found = words_of(texts)
    words = [found.hashes[found.first[i]: found.first[i + 1]] for i in range(len(texts))]
    known = np.zeros(1 << max(20, (32 * len(found.hashes)).bit_length()), dtype=bool)
    by_class: dict[int, list[int]] = {}
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if least_words <= len(w) < LEAST_WORDS and len(w):
            by_size.setdefault(len(w), []).append(i)
        elif len(w) >= max(LEAST_WORDS, least_words):
            known[_pair_slots(w, len(known))[:-1]] = True
            by_class.setdefault(int(math.log(len(w)) / math.log(1.15)), []).append(i)
    classes = []
    for items in by_class.values():
        sizes = [len(words[i]) for i in items]
        classes.append(size_class(min(sizes), max(sizes), items, words, target))
    short = {}
    for n, items in by_size.items():
        keys = np.concatenate([_sequences(words[i], n) for i in items])
        order = np.argsort(keys, kind="stable")
        short[n] = keys[order], np.array(items)[order]
    return Index(ids, words, classes, short, known)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of `item` to any part of `text`, with that part (earliest end, then latest begin)."""
    n = np.arange(len(text) + 1)
    cost, begin = np.zeros(len(n), dtype=np.int64), n.copy()
    for i, word in enumerate(item):
        kept, lost = cost[:-1] + (text != word), cost[1:] + 1
        nxt = np.concatenate([[i + 1], np.minimum(kept, lost)])
        source = np.concatenate([begin[:1], np.where(kept <= lost, begin[:-1], begin[1:])])
        level = nxt - n
        least = np.minimum.accumulate(level)
        from_ = np.maximum.accumulate(np.where(level == least, n, 0))
        cost, begin = least + n, source[from_]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def _starts(inside: np.ndarray, ends: np.ndarray, group: SizeClass) -> np.ndarray:
    """Starts of windows that hold enough word pairs of the benchmark; a window within the allowed edits does."""
    need = group.low - 1 - 2 * edits_allowed(group.high)
    sums = np.concatenate([[0], np.cumsum(inside)])
    at = np.arange(len(inside))
    return np.flatnonzero(sums[np.minimum(at + group.low - 1, ends)] - sums[at] >= need)


#: Windows of one size class whose walks are done together.
TOGETHER = 20_000


@dataclass
class Windows:
    """Screened windows of one size class with their surroundings, one row each."""

    margin: int
    words: list[np.ndarray]  # parts of shape (windows, margin + high + margin), 0 outside of the text
    text: list[np.ndarray]
    start: list[np.ndarray]  # number of the window's first word in its text
    stop: list[np.ndarray]  # number of words of the text from the window's first word on
    held: int = 0


def _gather(group: SizeClass, windows: Windows, starts: np.ndarray, hashes: np.ndarray, first: np.ndarray, of_text: np.ndarray) -> None:
    own = of_text[starts]
    at = starts[:, None] + np.arange(-windows.margin, group.high + windows.margin)[None, :]
    inside = (at >= first[own][:, None]) & (at < first[own + 1][:, None])
    windows.words.append(np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], np.uint64(0)))
    windows.text.append(own)
    windows.start.append(starts - first[own])
    windows.stop.append(first[own + 1] - starts)
    windows.held += len(starts)


def _resolve(index: Index, group: SizeClass, windows: Windows, best: dict[tuple[int, int], tuple[int, int, int]]) -> None:
    """Look up the windows' keys and verify what meets an item; `best` keeps the least distance and its place."""
    words = np.concatenate(windows.words)
    text, start, stop = (np.concatenate(x) for x in (windows.text, windows.start, windows.stop))
    width, margin = words.shape[1], windows.margin
    begin = np.arange(len(words)) * width + margin
    keys = walk_keys(words.ravel(), begin, begin + np.minimum(stop, group.high), group.places)
    met = [group.meets(row, values) for row, values in enumerate(keys)]
    pairs = np.unique(np.concatenate([item * len(words) + row for row, item in met]))
    items, rows = np.divmod(pairs, len(words))
    for item in np.unique(items).tolist():
        number = group.items[item]
        own = index.words[number]
        allowed = edits_allowed(len(own))
        mine = rows[items == item]
        a = margin - np.minimum(allowed, start[mine])
        b = margin + np.minimum(len(own) + allowed, stop[mine])
        near, common = words[mine], np.zeros(len(mine), dtype=np.int64)
        for word, times in zip(*np.unique(own, return_counts=True), strict=True):
            common += np.minimum((near == word).sum(axis=1), times)
        enough = common >= len(own) - allowed
        for row, c, d in zip(mine[enough].tolist(), a[enough].tolist(), b[enough].tolist(), strict=True):
            key = (int(text[row]), number)
            if key in best and best[key][0] == 0:
                continue
            cost, s, e = best_match(own, words[row, c:d])
            if cost <= allowed and e > s:
                place = int(start[row]) + c - margin
                found = (cost, place + e, place + s)
                best[key] = min(found, best.get(key, found))


def _verify_all(
    index: Index, group: ExactClass, starts: np.ndarray, hashes: np.ndarray, first: np.ndarray, of_text: np.ndarray, offset: int,
    best: dict[tuple[int, int], tuple[int, int, int]],
) -> None:
    """Compare every stretch of a text that screened windows cover with the items whose word pairs it holds."""
    reach = group.high + edits_allowed(group.high)
    for part in np.split(starts, np.flatnonzero((np.diff(starts) > reach) | (np.diff(of_text[starts]) != 0)) + 1):
        if not len(part):
            continue
        text = int(of_text[part[0]])
        begin, end = int(part[0]), min(int(part[-1]) + reach, int(first[text + 1]))
        for item, held in enumerate(group.hits(hashes[begin:end]).tolist()):
            own = index.words[group.items[item]]
            allowed = edits_allowed(len(own))
            if held < len(own) - 1 - 2 * allowed:
                continue
            cost, s, e = best_match(own, hashes[begin:end])
            if cost <= allowed and e > s:
                key, place = (text + offset, group.items[item]), begin - int(first[text])
                found = (cost, place + e, place + s)
                best[key] = min(found, best.get(key, found))


def _equal(
    index: Index, hashes: np.ndarray, first: np.ndarray, of_text: np.ndarray, offset: int, best: dict[tuple[int, int], tuple[int, int, int]],
) -> None:
    """The first place of every short item in every text that holds it."""
    for n, (keys, items) in index.short.items():
        runs = _sequences(hashes, n)
        at = np.flatnonzero(of_text[: len(runs)] == of_text[n - 1: n - 1 + len(runs)])
        a = np.searchsorted(keys, runs[at], side="left")
        times = np.searchsorted(keys, runs[at], side="right") - a
        hit = np.flatnonzero(times)
        for place, begin, number in zip(at[hit].tolist(), a[hit].tolist(), times[hit].tolist(), strict=True):
            text = int(of_text[place])
            start = place - int(first[text])
            for item in items[begin: begin + number].tolist():
                best.setdefault((text + offset, item), (0, start + n, start))


def search(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, distance, item words, first word, end word) of every leak; the best place of each item in each text."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    fresh = lambda group: Windows(edits_allowed(group.high), [], [], [], [])
    waiting = [fresh(group) for group in index.classes]
    for a, b in groups_of(texts):
        found = words_of(texts[a:b])
        if not len(found.hashes):
            continue
        of_text = np.repeat(np.arange(b - a), np.diff(found.first))
        _equal(index, found.hashes, found.first, of_text, a, best)
        inside = index.pairs_known(found.hashes)
        ends = found.first[1:][of_text]
        for i, group in enumerate(index.classes):
            starts = _starts(inside, ends, group)
            if group.exact:
                _verify_all(index, group, starts, found.hashes, found.first, of_text, a, best)
                continue
            for c in range(0, len(starts), TOGETHER):
                _gather(group, waiting[i], starts[c: c + TOGETHER], found.hashes, found.first, of_text)
                waiting[i].text[-1] = waiting[i].text[-1] + a
                if waiting[i].held >= TOGETHER:
                    _resolve(index, group, waiting[i], best)
                    waiting[i] = fresh(group)
    for group, windows in zip(index.classes, waiting, strict=True):
        if windows.held:
            _resolve(index, group, windows, best)
    return [
        (text, item, cost, len(index.words[item]), begin, end) for (text, item), (cost, end, begin) in sorted(best.items())
    ]


def _indexes(benchmark: DataFrame, target: float, least_words: int = 1) -> Iterator[tuple[Index, bool]]:
    """The benchmark in blocks of bounded size, one after the other, and whether there are several."""
    items = benchmark.select("item_id", text_of(F.col("text")).alias("text"))
    total = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()
    passes = max(1, math.ceil(total.n / BLOCK_ITEMS), math.ceil(total.c / BLOCK_CHARS))
    for number in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        rows = block.orderBy("item_id", "text").collect()
        yield build_index([r.item_id for r in rows], [r.text for r in rows], target, least_words), passes > 1


def leaks(docs: DataFrame, benchmark: DataFrame, target: float = 0.99) -> DataFrame:
    """doc_id, item_id, distance, item_words, similarity, first_word, end_word: every document row with every item it holds.

    An item of n words is held where the word edit distance to some part of the document
    is at most 0.2 n; the least distance found is given, at its earliest end. Items of under five words
    thus have to stand there word by word.

    Null or wordless documents hold nothing, null or wordless items are held by none. Repeated documents and
    items are reported each. Long documents are searched whole. Without documents or items: no rows.
    Of a benchmark of several blocks, one is in memory at a time; the rows of each are written.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    names = ["doc_id", "item_id", "distance", "item_words", "similarity", "first_word", "end_word"]
    schema = f"doc_id long, item_id {kind}, distance int, item_words int, similarity double, first_word long, end_word long"

    def searched(index: Index) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                held, ids = batch["text"].tolist(), batch["doc_id"].tolist()
                rows = [
                    (ids[text], index.ids[item], cost, n, 1 - cost / n, first, end)
                    for text, item, cost, n, first, end in search(held, index)
                ]
                yield pd.DataFrame(rows, columns=names)

        return texts.mapInPandas(run, schema)

    parts = [stored(searched(index), "leaks") if several else searched(index) for index, several in _indexes(benchmark, target)]
    return reduce(DataFrame.unionByName, parts)


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, target: float = 0.99, least_words: int = LEAST_WORDS
) -> DataFrame:
    """The rows of docs, with all their columns, whose text holds no benchmark item of `least_words` words or more.

    Shorter items are no evidence of a leak: plain phrases would take clean documents away.
    """
    ship(docs.sparkSession)
    rows = packed(docs)
    text = text_of(F.col("row.text"))

    def holds(index: Index) -> Column:
        @F.arrow_udf("boolean")
        def held(texts: pa.Array) -> pa.Array:
            out = np.zeros(len(texts), dtype=bool)
            for leak in search(texts.to_pylist(), index):
                out[leak[0]] = True
            return pa.array(out)

        return held(text)

    key = [F.xxhash64(text).alias("text_hash"), F.crc32(text.cast("binary")).alias("text_crc"), F.octet_length(text).alias("size")]
    found = []
    for index, several in _indexes(benchmark, target, least_words):
        if not several:
            return rows.where(~holds(index)).select("row.*")
        found.append(stored(rows.where(holds(index)).select(*key).distinct(), "leaking"))
    leaking = reduce(DataFrame.unionByName, found).distinct()
    return rows.select("row", *key).join(leaking, ["text_hash", "text_crc", "size"], "left_anti").select("row.*")
