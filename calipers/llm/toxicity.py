"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, other). Four
small transducers rewrite the symbols of a clause one after the other: negation marks
what stands in its scope, reported speech marks what follows in the clause, targets mark
what is aimed at somebody, threats need a target. They are composed once into a single
table; running it over a clause gives the matches of the clause. The weights of the
matches, and further insults, are learnt from labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import by_size, packed, stored, text_of
from calipers.runtime import ship

# The words that the grammar knows before it has seen any label.
INSULTS = """
    airhead arsehole ass asshole bastard bitch bonehead bozo brainless buffoon bum clown coward creep cretin
    cunt degenerate dickhead dimwit dipshit disgusting dork douche dumb dumbass dummy dunce fool freak garbage goon
    halfwit hypocrite idiot idiotic ignorant imbecile jackass jerk knucklehead leech liar loser lowlife maggot
    moron moronic nitwit numbskull oaf parasite pathetic pig pinhead prick psycho rat repulsive scum scumbag shithead
    simpleton sleazebag slob slut snake stupid subhuman thug trash troll twat twit useless vermin vile wanker
    weasel weirdo whore wimp worthless wretch abruti connard crétin débile ordure pourriture salaud arschloch
    abschaum depp dummkopf idioten trottel vollidiot wichser cabrón estúpido gilipollas idiota imbécil
""".split()
THREATS = """
    kill murder destroy hurt stab shoot strangle beat burn hang slaughter choke punch smash crush tuer töten matar
""".split()
TARGETS = """
    you your yours yourself u ur he him his she her hers they them their we us people everyone anyone someone
    somebody everybody guys folks toi tu vous ton votre du dich dir ihr euch sie tú te usted ustedes vosotros
""".split()
NEGATIONS = """
    not no never none nobody neither nor without cannot hardly isn aren wasn weren don doesn didn won pas jamais
    nicht kein keine nie nunca
""".split()
REPORTS = """
    said says say told called calls wrote writes quoted quotes claimed claims alleged reported reports according
    replied argued stated heard dit sagte dijo
""".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
#: What a clause can match, with the weight each match has before any label is seen.
MATCHES = {"insult": 2.0, "aimed": 3.0, "negated": 1.0, "reported": 1.0, "threat": 3.0, "reported_threat": 1.0}
NEGATION_SCOPE, TARGET_SCOPE, THREAT_SCOPE = 3, 4, 4

_TOKEN = re.compile(r"[^\W_]+(?:[@$0-9]+[^\W_]+)*|[.!?;:\n]")
_CLAUSE_ENDS = frozenset(".!?;:\n")
_PLAIN_LETTERS = tuple(str.maketrans("013457@$", "o" + one + "eastas") for one in "il")
#: Matching clauses beyond so many count less and less: n more as log(1 + n).
FULL_CLAUSES = 3


@dataclass(frozen=True)
class Transducer:
    """Letter-to-letter: `step(state, symbol)` gives the next state and the output symbol."""

    start: object
    step: Callable[[object, object], tuple[object, object]]

    def then(self, other: Transducer) -> Transducer:
        """Composition: this one's output is the other's input."""
        def step(state: tuple, symbol: object) -> tuple:
            first, out = self.step(state[0], symbol)
            second, out = other.step(state[1], out)
            return (first, second), out

        return Transducer((self.start, other.start), step)


def _negation(left: int, symbol: int) -> tuple[int, tuple]:
    if symbol == NEGATION:
        return NEGATION_SCOPE, (symbol, False)
    return max(0, left - 1), (symbol, left > 0)


def _report(on: bool, seen: tuple) -> tuple[bool, tuple]:
    return on or seen[0] == REPORT, (*seen, on)


def _aim(state: tuple[int, int], seen: tuple) -> tuple[tuple[int, int], tuple]:
    """state: words left in which a target before, or an insult before, still counts."""
    target, insult = state
    symbol, negated, _ = seen
    if symbol == TARGET:
        return (TARGET_SCOPE, 0), (*seen, insult > 0)
    aimed = symbol == INSULT and target > 0
    insult = TARGET_SCOPE if symbol == INSULT and not negated and not aimed else max(0, insult - 1)
    return (max(0, target - 1), insult), (*seen, aimed)


def _match(threat: int, seen: tuple) -> tuple[int, str]:
    """Names what was matched here; a threat waits for its target."""
    symbol, negated, reported, aimed = seen
    if symbol == THREAT and not negated:
        return THREAT_SCOPE, ""
    if symbol == TARGET:
        if threat:
            return 0, "reported_threat" if reported else "threat"
        return 0, "aimed" if aimed and not reported else ""
    left = max(0, threat - 1)
    if symbol != INSULT:
        return left, ""
    if negated:
        return left, "negated"
    if reported:
        return left, "reported"
    return left, "aimed" if aimed else "insult"


GRAMMAR = Transducer(0, _negation).then(Transducer(False, _report)).then(Transducer((0, 0), _aim)).then(
    Transducer(0, _match)
)


def compiled(grammar: Transducer, alphabet: range) -> tuple[list[list[int]], list[list[str]]]:
    """Next state and output by state number and symbol, for all states that can be reached."""
    states, number = [grammar.start], {grammar.start: 0}
    moves, outputs = [], []
    for state in states:  # grows while new states turn up
        row, out = [], []
        for symbol in alphabet:
            nxt, match = grammar.step(state, symbol)
            if nxt not in number:
                number[nxt] = len(states)
                states.append(nxt)
            row.append(number[nxt])
            out.append(match)
        moves.append(row)
        outputs.append(out)
    return moves, outputs


def lexicon(learnt: list[str]) -> dict[str, int]:
    known = dict.fromkeys([*INSULTS, *learnt], INSULT)
    for words, symbol in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
        known |= dict.fromkeys(words, symbol)
    return known


def clause_matches(text: str, known: dict[str, int], moves: list, outputs: list) -> Counter:
    """How many clauses of `text` have each match."""
    tokens = _TOKEN.findall(text.lower())
    distinct = set(tokens)
    symbols = {t: known.get(t, OTHER) for t in distinct}
    for token in distinct:
        if symbols[token] == OTHER and not token.isalpha() and not token.isdigit() and token not in _CLAUSE_ENDS:
            plain = (known.get(token.translate(letters), OTHER) for letters in _PLAIN_LETTERS)
            symbols[token] = min(plain, key=lambda s: s == OTHER)
    found: Counter = Counter()
    if not any(s in (INSULT, THREAT) for s in symbols.values()):
        return found
    state, clause = 0, set()
    for token in [*tokens, "."]:
        if token in _CLAUSE_ENDS:
            found.update(clause)
            state, clause = 0, set()
            continue
        symbol = symbols[token]
        if match := outputs[state][symbol]:
            clause.add(match)
        state = moves[state][symbol]
    return found


def match_counts(texts: DataFrame, learnt: list[str]) -> DataFrame:
    """`texts` (key columns, text) with one int column per match in place of the text."""
    ship(texts.sparkSession)
    known = lexicon(learnt)
    moves, outputs = compiled(GRAMMAR, range(6))
    keys = [f for f in texts.schema.fields if f.name != "text"]
    names = [f.name for f in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            found = [clause_matches(t, known, moves, outputs) for t in batch.column("text").to_pylist()]
            counts = [pa.array([c[name] for c in found], pa.int32()) for name in MATCHES]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *counts], [*names, *MATCHES])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys), *(f"{m} int" for m in MATCHES)])
    return texts.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, toxic of at most about `most` labelled rows that are not held out, chosen by a hash of the id."""
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share, among = min(1.0, most / max(1, marks.count())), 1 << 40
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(among)) < math.ceil(share * among))
    rows = docs.select("doc_id", text_of(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return stored(rows.select("text", "toxic"), "labelled")


def learn_insults(rows: DataFrame, least: int = 8, purity: float = 0.95, most: int = 1_000) -> list[str]:
    """Words that stand almost only in toxic rows, after at least `least` different words.

    Words of a toxic text that was copied often stand after the same word in every copy,
    so they do not pass. The `most` words with the most toxic rows are taken.
    """
    tokens = rows.withColumn("id", F.monotonically_increasing_id()).select(
        "id", "toxic", F.split(F.lower("text"), r"[^\p{L}]+").alias("w")
    )
    pairs = tokens.select("id", "toxic", F.explode(F.arrays_zip(
        F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("before")
    )).alias("p")).select("id", "toxic", "p.word", "p.before").where("length(word) between 3 and 40")
    places = pairs.groupBy("word", "toxic", "before").agg(F.count(F.lit(1)).alias("n"))
    counts = places.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("contexts"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("clean"),
    )
    passed = counts.where((F.col("contexts") >= least) & (F.col("bad") >= purity * (F.col("bad") + F.col("clean"))))
    return sorted(r.word for r in passed.orderBy(F.desc("bad"), "word").limit(most).select("word").collect())


def damped(counts: np.ndarray) -> np.ndarray:
    """Counts of clauses as features."""
    return np.where(counts <= FULL_CLAUSES, counts, FULL_CLAUSES + np.log1p(np.maximum(0, counts - FULL_CLAUSES)))


def fit_weights(counts: list[tuple], prior: float = 4.0, rounds: int = 60) -> tuple[float, list[float]]:
    """Bias and weights of a logistic model by Newton's method, drawn to the grammar's own weights.

    counts: (feature counts..., toxic, rows). Without any row the grammar's weights stay.
    """
    own = np.array([-3.0, *MATCHES.values()])
    if not counts:
        return own[0], list(own[1:])
    data = np.array(counts, dtype=float)
    x = np.hstack([np.ones((len(data), 1)), damped(data[:, : len(MATCHES)])])
    y, n = data[:, -2], data[:, -1]
    w = own.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + (w - own) / prior
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / prior
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), [float(v) for v in w[1:]]


@dataclass(frozen=True)
class Model:
    learnt: list[str]
    bias: float
    weights: list[float]

    def score(self) -> Column:
        linear = F.lit(self.bias)
        for name, weight in zip(MATCHES, self.weights, strict=True):
            count = F.col(name)
            feature = F.when(count <= FULL_CLAUSES, count.cast("double")).otherwise(FULL_CLAUSES + F.log1p(count - FULL_CLAUSES))
            linear = linear + F.lit(weight) * feature
        return F.round(1 / (1 + F.exp(-linear)), 12)


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> Model:
    """Fit on at most about `most` labelled rows; feature vectors are counted in Spark, the driver sees the counts."""
    rows = training_rows(docs, labels, most)
    learnt = learn_insults(rows)
    vectors = match_counts(rows.select("toxic", "text"), learnt).groupBy(*MATCHES, "toxic").agg(F.count(F.lit(1)))
    bias, weights = fit_weights(sorted(tuple(r) for r in vectors.collect()))
    return Model(learnt, bias, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Null or empty text has no match: its score is that of the bias. Repeated rows get
    equal rows. No rows: no rows. Only the text is an input of the score.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    scored = match_counts(texts, model.learnt).withColumn("score", model.score())
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), *MATCHES,
    )


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, whose text the model does not call toxic."""
    ship(docs.sparkSession)
    known = lexicon(model.learnt)
    moves, outputs = compiled(GRAMMAR, range(6))
    names, weights, bias = list(MATCHES), model.weights, model.bias

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for part in by_size(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            found = [clause_matches(t, known, moves, outputs) for t in part.column("text").to_pylist()]
            counts = np.array([[c[n] for n in names] for c in found], dtype=float).reshape(-1, len(names))
            out.append(damped(counts) @ np.array(weights) + bias < 0)
        return pa.array(np.concatenate([np.zeros(0, dtype=bool), *out]))

    return packed(docs).where(clean(text_of(F.col("row.text")))).select("row.*")
