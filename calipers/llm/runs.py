"""Periodic runs of words by minimizers at several scales.

A run is a stretch of words, at least twice as long as its smallest period q, that no
neighbouring word extends with that period. Periods below SHORT are found by comparing the words
with themselves, q places later, for every such q. Longer ones are found scale by scale, for
P <= q < 2P and P doubling:

* From every window of P words its minimizer is taken, the string of k = P/4 words with the least
  hash. A run of period q holds a window and, q words later, an equal one; both have the same
  minimizer. So pairs of equal minimizers at a distance in [P, 2P) are seeds, each of which is
  extended both ways as far as the words repeat.
* A string of k words without a period of k/2 or less recurs within 2P words 15 times at most, so
  each minimizer meets the next 15 equal ones. Strings with such a period lie in runs of shorter periods,
  known from the scales before, and are no minimizers.
* What has no minimizers then are runs whose first period lies wholly in a run of a period
  d <= P/8. Such a run ends where the next one of period d begins, and q is told by the
  phases of the two, give or take multiples of d: these are seeds too, fewer than words.

So the result is whole, and the time for a text of n words is about n log n.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import by_size, text_of
from calipers.llm.words import mixed, powers, spaced_words
from calipers.runtime import ship

#: Least number of words of a run that is reported.
LEAST = 12
#: Periods below are found by direct lag scans; a power of two, 32 at least.
SHORT = 32

_BASE = 0xA24BAED4963EE407
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_NO_RANK = np.uint64(2**32 - 1)
_RUNS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Runs:
    """Runs by their first word, the word after their last, and their period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def where(self, mask: np.ndarray) -> Runs:
        return Runs(self.start[mask], self.end[mask], self.period[mask])

    def smallest(self) -> Runs:
        """One run for each stretch, with its smallest period."""
        order = np.lexsort((self.period, self.end, self.start))
        sorted_ = self.where(order)
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(sorted_.start) != 0) | (np.diff(sorted_.end) != 0)
        return sorted_.where(new)


def _joined(parts: list[Runs]) -> Runs:
    return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "end", "period"))).smallest()


def _short(words: np.ndarray, short: int, least: int) -> Runs:
    """Runs of periods below `short`, and of `least` words, by direct lag scans."""
    starts, ends, periods = [], [], []
    for q in range(1, min(short, len(words))):
        same = np.flatnonzero(words[q:] == words[:-q])
        if not len(same):
            continue
        breaks = np.flatnonzero(np.diff(same) > 1)
        begin = same[np.append(0, breaks + 1)]
        end = same[np.append(breaks, len(same) - 1)] + 1
        kept = end - begin >= max(q, least - q)
        starts.append(begin[kept])
        ends.append(end[kept] + q)
        periods.append(np.full(int(kept.sum()), q))
    none = np.zeros(0, dtype=np.int64)
    return Runs(*(np.concatenate([none, *x]).astype(np.int64) for x in (starts, ends, periods))).smallest()


class Scale:
    """The words of some texts, and hashes of their strings."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mixed(words.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * powers(_BASE, len(words)), out=self.sums[1:])
        self.back = powers(_BASE_INVERSE, len(words) + 1)

    def hashes(self, begin: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[begin + size] - self.sums[begin]) * self.back[begin]

    def minimizer_seeds(self, p: int, known: Runs) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances in [p, 2p) of equal minimizers of windows of p words."""
        k = p // 4
        n = len(self.words) - k + 1
        grams = mixed((self.sums[k:] - self.sums[:n]) * self.back[:n])
        rank = np.minimum(grams >> np.uint64(32), _NO_RANK - np.uint64(1))
        periodic = known.where((known.period <= k // 2) & (known.end - known.start >= k))
        marks = np.zeros(n + 1, dtype=np.int32)
        np.add.at(marks, periodic.start, 1)
        np.add.at(marks, periodic.end - k + 1, -1)
        rank[np.cumsum(marks[:n]) > 0] = _NO_RANK
        least = rank << np.uint64(32) | np.arange(n, dtype=np.uint64)  # equal ranks: the first place
        width, reach = p - k + 1, 1
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        chosen = least[np.append(True, least[1:] != least[:-1])]
        place = (chosen[chosen >> np.uint64(32) != _NO_RANK] & np.uint64(2**32 - 1)).astype(np.int64)
        place = place[np.argsort(grams[place], kind="stable")]
        gram = grams[place]
        seeds, distances = [place[:0]], [place[:0]]
        for ahead in range(1, 16):
            same = np.flatnonzero(gram[ahead:] == gram[:-ahead])
            if not len(same):
                break
            distance = place[same + ahead] - place[same]
            kept = (distance >= p) & (distance < 2 * p)
            seeds.append(place[same[kept]])
            distances.append(distance[kept])
        return np.concatenate(seeds), np.concatenate(distances)

    def phase_seeds(self, p: int, known: Runs) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances in [p, 2p) told by neighbouring runs of one short period."""
        runs = known.where((known.period <= p // 8) & (known.end - known.start >= p))
        runs = runs.where(np.lexsort((runs.start, runs.period)))
        pair = np.flatnonzero((runs.period[1:] == runs.period[:-1]) & (runs.start[1:] <= runs.end[:-1]))
        pair = pair[runs.end[pair] + runs.period[pair] <= runs.end[pair + 1]]
        seeds, distances = [pair[:0]], [pair[:0]]
        for start, end, d in zip(runs.start[pair], runs.end[pair], runs.period[pair], strict=True):
            before = end - d - np.arange(d)
            phase = np.flatnonzero(self.hashes(before, d) == self.hashes(end[None], d))
            if len(phase):
                distance = np.arange(d + phase[0], min(2 * p, end - start + 1), d)
                distance = distance[distance >= p]
                seeds.append(end - distance)
                distances.append(distance)
        return np.concatenate(seeds), np.concatenate(distances)

    def _reach(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many words from a < b on (or before them) are equal, by bisection; equal hashes count as equal words."""
        low = np.zeros(len(a), dtype=np.int64)
        high = a.copy() if back else len(self.words) - b
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            shift = -middle if back else 0
            same = self.hashes(a + shift, middle) == self.hashes(b + shift, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def _stretch(self, seed: int, q: int) -> tuple[int, int]:
        """The same for one seed by comparing words."""
        differ = np.flatnonzero(self.words[:-q] != self.words[q:])
        at = np.searchsorted(differ, seed)
        return (int(differ[at - 1]) + 1 if at else 0), (int(differ[at]) if at < len(differ) else len(self.words) - q)

    def extended(self, seed: np.ndarray, q: np.ndarray) -> Runs:
        """The runs around seeds; every one is checked word by word."""
        begin = seed - self._reach(seed, seed + q, True)
        end = seed + self._reach(seed, seed + q, False)
        found = np.flatnonzero(end - begin >= q)
        _, first = np.unique(np.stack([begin[found], end[found], q[found]], axis=1), axis=0, return_index=True)
        rows = []
        for i in found[first]:
            b, e, d = int(begin[i]), int(end[i]), int(q[i])
            if not np.array_equal(self.words[b:e], self.words[b + d: e + d]):
                b, e = self._stretch(int(seed[i]), d)
            if e - b >= d:
                rows.append((b, e + d, d))
        return Runs(*np.array(rows, dtype=np.int64).reshape(-1, 3).T)


def runs_of(words: np.ndarray, counts: np.ndarray, least: int = LEAST, short: int = SHORT) -> tuple[np.ndarray, Runs]:
    """The text's number of each run, and the runs by their words' numbers in the text, by text, start and period.

    words: a number from 0 for each word, of all texts; counts: how many each text has.
    """
    # every text stands between words that occur once
    sizes = np.append(counts, 0)
    first = np.cumsum(sizes + 1) - sizes  # of each text's words
    whole = -1 - np.arange(len(words) + len(sizes), dtype=np.int64)
    whole[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts) + 1] = words
    known = _short(whole.astype(np.int32) if len(whole) < 2**31 else whole, short, min(least, short // 4))
    p = short
    while (long_ := np.flatnonzero(counts >= 2 * p)).size:
        spans = counts[long_] + 1
        inside = np.repeat(first[long_] - 1, spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        inside = np.append(inside, first[long_[-1]] + counts[long_[-1]])
        of_these = known.where((known.end - known.start >= p // 4) & (counts[np.searchsorted(first, known.start, side="right") - 1] >= 2 * p))
        here = Runs(np.searchsorted(inside, of_these.start), np.searchsorted(inside, of_these.end - 1) + 1, of_these.period)
        scale = Scale(whole[inside])
        seeds = [scale.minimizer_seeds(p, here), scale.phase_seeds(p, here)]
        new = scale.extended(*(np.concatenate(x) for x in zip(*seeds, strict=True)))
        known = _joined([known, Runs(inside[new.start], inside[new.end - 1] + 1, new.period)])
        p *= 2
    known = known.where(known.end - known.start >= np.maximum(least, 2 * known.period))
    text = np.searchsorted(first, known.start, side="right") - 1
    known = Runs(known.start - first[text], known.end - first[text], known.period)
    order = np.lexsort((known.period, known.start, text))
    return text[order], known.where(order)


def find(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, runs (start, length, period in words), collapsed of every row of docs; docs: doc_id, text.

    Words are what stands between ASCII white space. `collapsed` is the text's words, joined by one
    space, without those that some run holds after its first period. Runs come by start, then
    period. Null, empty and white texts: no runs, and an empty text. Repeated rows get equal rows, null ids
    are kept, texts of any length are searched whole. No rows: no rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            words, counts, number, _ = spaced_words(part.column("text").to_pylist())
            text, runs = runs_of(number, counts, least)
            first = np.cumsum(counts) - counts
            marks = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(marks, first[text] + runs.start + runs.period, 1)
            np.add.at(marks, first[text] + runs.end, -1)
            kept = np.cumsum(marks[:-1]) == 0
            collapsed = []
            for a, n in zip(first.tolist(), counts.tolist(), strict=True):
                own = kept[a: a + n]
                left = words[a: a + n] if own.all() else [words[a + i] for i in np.flatnonzero(own)]
                collapsed.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            bounds = np.searchsorted(text, np.arange(len(counts) + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays([pa.array(x) for x in (runs.start, runs.end - runs.start, runs.period)], fields=list(_RUNS))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), found), pa.array(collapsed, pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, told by the id's checksum, end in a loop of their own words.

    With h the checksum of the decimal id, g = h div 10 and n words: where h is divisible by 10, each
    word i from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    A null id has no checksum, and its text stays.
    """
    text = text_of(F.col("text"))
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h.alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    g, n = F.expr("h div 10"), F.size("words")
    of_chosen = chosen.withColumn("words", F.when(F.expr("h % 10 = 0"), words)).withColumn("a", F.when(n > 0, g % n))
    period = F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)")

    def word(i: Column) -> Column:
        a = F.col("a").cast("int")
        return F.get("words", F.when(i < a, i).otherwise(a + (i - a) % F.col("p").cast("int")))

    loop = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return of_chosen.withColumn("p", period).select("doc_id", F.when(F.col("a").isNotNull(), loop).otherwise(F.col("text")).alias("text"))


def run_rows(docs: DataFrame) -> DataFrame:
    """The digest of `find` over texts of which a tenth is looped: the longest run, and checksums of all runs and of what is left."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start, -r.period)))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    found = find(looped(docs)).withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.col3")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.when(period > 0, F.floor(1000 * length / period)).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
