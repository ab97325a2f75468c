"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer, learned from labelled rows, turns tokens into symbols with weights; small
transducers for negation, reported speech, and targeted patterns are composed into one machine that
turns the symbols of a clause into matched events. Events, not words, are what is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import checkpointed, id_crc, read, tidy

#: Labelled rows of each class that are learned from, in expectation: whole texts, chosen by hash.
SAMPLE = 8000
#: How many times as many rows may be read where ids repeat with other texts.
MOST = 4
#: Stems of these lengths stand for all words that begin with them.
STEMS = (3, 4, 5, 6, 7)
THRESHOLD = 0.7
_MEMO = 500_000

# Function words of four languages that the grammar's symbols stand for.
VERBS = "kill hurt destroy beat shoot stab burn hang".split()
THREATS = "töten schlagen erschießen verbrennen tuer frapper détruire brûler matar golpear destruir quemar".split()
TARGETS = "you your yours u he she they them him her people du dich dir ihr euch tu toi vous ton votre ils elles tú usted ustedes vosotros ellos".split()
NEGATIONS = "not no never cannot don't isn't aren't won't nicht kein keine nie niemals ne pas jamais nunca jamás tampoco".split()
REPORTS = "said says say quoted quote wrote writes called claims claimed sagte sagt schrieb dit écrit déclare dijo dice escribió".split()


def inflected(verb: str) -> list[str]:
    """An English verb's regular forms; irregular ones aren't made."""
    stem = verb.removesuffix("e")
    double = verb + verb[-1] if len(verb) == 4 and verb[-1] in "bt" and verb[-2] in "aeiou" and verb[-3] not in "aeiou" else stem
    return [verb, verb + "s", double + "ed", double + "ing"]


OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "o", "I", "V", "P", "N", "R"
DIRECT, AIMED = "D", "T"
NEGATED, QUOTED = {INSULT: "i", THREAT: "v"}, {INSULT: "q", THREAT: "w", "i": "q", "v": "w"}
#: What a clause can match, and how much of the lexicon's weight it is born with; fitting changes that.
EVENTS = ("bare", "direct", "threat", "negated", "reported")


class Transducer(NamedTuple):
    """A deterministic machine: arcs map (state, symbol) to (state, output). Symbols without an arc stay as they are."""

    start: object
    arcs: dict

    def step(self, state: object, symbol: str) -> tuple[object, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(one: Transducer, two: Transducer, symbols: str) -> Transducer:
    """The machine that reads what one reads and writes what two makes of one's output."""
    start = (one.start, two.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            a, middle = one.step(state[0], symbol)
            b, out = two.step(state[1], middle)
            arcs[state, symbol] = ((a, b), out)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return Transducer(start, arcs)


def negation(reach: int = 2) -> Transducer:
    """Within reach tokens after a negation, insults and threats come out negated."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in (OTHER, INSULT, THREAT, TARGET, REPORT):
            out = NEGATED.get(symbol, symbol) if left else symbol
            arcs[left, symbol] = (max(0, left - 1), out)
        arcs[left, NEGATION] = (reach, NEGATION)
    return Transducer(0, arcs)


def reported() -> Transducer:
    """From a verb of speaking on, to the end of the clause, insults and threats come out as quoted."""
    arcs = {("plain", REPORT): ("said", REPORT)}
    arcs |= {("said", a): ("said", b) for a, b in QUOTED.items()}
    return Transducer("plain", arcs)


def target() -> Transducer:
    """Behind a target, to the end of the clause, insults come out as direct and threats as aimed; a target behind an insult comes out as direct."""
    aimed, named = "target", "insult"
    arcs = {("none", TARGET): (aimed, TARGET), (aimed, INSULT): (aimed, DIRECT), (aimed, THREAT): (aimed, AIMED)}
    return Transducer("none", arcs | {("none", INSULT): (named, INSULT), (named, TARGET): (aimed, DIRECT)})


def insult() -> Transducer:
    """What is left of an insult becomes an event: bare, direct, negated or reported."""
    return Transducer(0, {(0, symbol): (0, event) for symbol, event in ((INSULT, "bare"), (DIRECT, "direct"), (NEGATED[INSULT], "negated"), (QUOTED[INSULT], "reported"))})


def threat() -> Transducer:
    """Aimed threats become events, and so do negated and reported ones; one at nobody is none. All that isn't an event ends here."""
    arcs = {(0, symbol): (0, event) for symbol, event in ((AIMED, "threat"), (NEGATED[THREAT], "negated"), (QUOTED[THREAT], "reported"))}
    return Transducer(0, arcs | {(0, symbol): (0, "") for symbol in (OTHER, THREAT, TARGET, NEGATION, REPORT)})


def machine() -> Transducer:
    """Negation, reported speech, target, insult and threat, composed into one machine over the lexicon's symbols."""
    whole = negation()
    for part in (reported(), target(), insult(), threat()):
        whole = compose(whole, part, OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT)
    return whole


def trimmed(token: str) -> str:
    """A token without what isn't a letter or digit at its ends."""
    lo, hi = 0, len(token)
    while lo < hi and not token[lo].isalnum():
        lo += 1
    while hi > lo and not token[hi - 1].isalnum():
        hi -= 1
    return token[lo:hi]


class Lexicon(dict):
    """Token to (symbol, weight, whether a clause ends after it), remembered. learned maps words and stems* to weights."""

    def __init__(self, learned: dict[str, float]) -> None:
        self.learned = learned
        self.fixed = dict.fromkeys(REPORTS, REPORT) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(TARGETS, TARGET) | dict.fromkeys([*THREATS, *(form for verb in VERBS for form in inflected(verb))], THREAT)

    def __missing__(self, token: str) -> tuple[str, float, bool]:
        word = trimmed(token)
        weight = max([self.learned.get(word, 0.0), *(self.learned.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n)])
        symbol = INSULT if weight else self.fixed.get(word, OTHER)
        if len(self) >= _MEMO:
            self.clear()
        found = self[token] = (symbol, weight or float(symbol == THREAT), token[-1] in ".!?;:")
        return found


def events(text: str, lexicon: Lexicon, fst: Transducer) -> np.ndarray:
    """For each kind of event, the sum over clauses of the weightiest match; then the weightiest of all, and all of them a hundred words."""
    totals = np.zeros(len(EVENTS) + 2)
    found = list(map(lexicon.__getitem__, text.lower().split()))
    if not any(s in (INSULT, THREAT) for s, _, _ in found):
        return totals
    state, best, most_of_all, named = fst.start, {}, 0.0, 0.0
    for symbol, weight, ends in found:
        state, out = fst.step(state, symbol)
        if symbol == INSULT:
            named = max(named, weight)
        if out:
            weight = weight or named  # a target behind an insult weighs what that does
            best[out] = max(best.get(out, 0.0), weight)
            most_of_all = max(most_of_all, weight)
        if ends:
            for event, most in best.items():
                totals[EVENTS.index(event)] += most
            state, best, named = fst.start, {}, 0.0
    for event, most in best.items():
        totals[EVENTS.index(event)] += most
    totals[-2] = most_of_all
    totals[-1] = 100 * totals[: len(EVENTS)].sum() / (len(found) + 20)
    return totals


def features(text: str) -> set[str]:
    """Distinct words of a text and their stems."""
    found = {trimmed(t) for t in set(text.lower().split())} - {""}
    return found | {w[:n] + "*" for w, n in product(found, STEMS) if len(w) > n}


class Model(NamedTuple):
    """A lexicon and the coefficients of the events; the last coefficient stands alone."""

    learned: dict[str, float]
    coefficients: np.ndarray

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(np.log1p(found) @ self.coefficients[:-1] + self.coefficients[-1]))))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Penalised logistic regression by Newton's method; the last coefficient is the constant."""
    x = np.column_stack([np.log1p(x), np.ones(len(x))])
    out, ridge = np.zeros(x.shape[1]), np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ out)
        out -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """A model from labelled rows (id, toxic 0 or 1); rows without text, id or label are passed over.

    About `sample` rows of each class (all, where there are fewer) are read, and a row that repeats
    once; of ids that many texts share, no more than MOST times as many. The driver gets a few numbers
    for each of those rows, and the entries of the lexicon, which are far more frequent in toxic texts
    of the sample than chance allows among so many candidates; an entry's weight is the log ratio.
    """
    truth = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in truth.groupBy("toxic").count().collect()}
    base = Model({}, np.array([0.0] * (len(EVENTS) + 2) + [np.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))]))
    if not sizes.get(0) or not sizes.get(1):
        return base
    chance = F.pmod(F.xxhash64(F.lit(6), id_col), F.lit(1 << 20))
    limit = {y: min(1 << 20, round((1 << 20) * sample / n)) for y, n in sizes.items()}
    chosen = truth.where(chance < F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0])).select(F.col(id_col).alias("_id"), "toxic")
    # At most about 2 * sample rows of two numbers, whatever the size of the table.
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    found = rows.groupBy("toxic", "_id", F.xxhash64("text").alias("digest"))
    given = checkpointed(found.agg(F.first("text").alias("text")).select("toxic", "text"))
    read_rows = given.count()
    if read_rows > MOST * 2 * sample:
        given = given.where(F.pmod(F.xxhash64(F.lit(9), "text"), F.lit(1 << 20)) < round((1 << 20) * MOST * 2 * sample / read_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[str, list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for feature in features(text):
                    totals.setdefault(feature, [0, 0])[toxic] += 1
            names = list(totals)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([totals[n][y] for n in names], pa.int64()) for y in (0, 1))], names=["feature", "clean", "toxic"])

    counted = given.mapInArrow(tidy(count), "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    taken = {r[0]: r[1] for r in given.groupBy("toxic").count().collect()}
    n0, n1 = taken.get(0, 0), taken.get(1, 0)
    if not n0 or not n1:
        return base
    p0, p1 = F.col("clean") / n0, F.col("toxic") / n1
    both = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    z = (p1 - p0) / F.sqrt(both * (1 - both) * (1 / n0 + 1 / n1) + 1e-12)
    ratio = F.log((F.col("toxic") + 1) / (n1 + 2)) - F.log((F.col("clean") + 1) / (n0 + 2))
    strict = 5.5  # one of a million candidates passes by chance once in fifty tables
    top = counted.where(F.col("toxic") >= 3).select("feature", z.alias("z"), ratio.alias("ratio")).where((F.col("z") >= strict) & (F.col("ratio") >= 2.0))
    rows = {r[0]: r[1] for r in top.select("feature", "ratio").collect()}
    # A word goes without an entry of its own where a stem of it is as telling.
    learned = {f: w for f, w in rows.items() if not any(rows.get(f.rstrip("*")[:n] + "*", -1) >= w - 0.5 for n in STEMS if len(f.rstrip("*")) > n)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, fst = Lexicon(learned), machine()
        for batch in batches:
            found = [events(t, lexicon, fst) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([f.tolist() for f in found], pa.list_(pa.float64()))], names=["toxic", "events"])

    seen = given.mapInArrow(look, "toxic long, events array<double>").collect()
    if not seen:
        return base
    y, x = np.array([r[0] for r in seen], float), np.array([r[1] for r in seen], float)
    weight = np.where(y == 1, sizes[1] / n1, sizes[0] / n0)
    return Model(learned, _fit(x, y, weight / weight.mean()))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with toxicity, from 0 to 1, of the whole text. A null or empty text has the score of one without events.

    All columns of docs stay but for one named toxicity.
    """
    kept = [c for c in docs.columns if c != "toxicity"]
    given = docs.select(*kept, F.col(text_col).alias("_text")).toDF(*(f"_c{i}" for i in range(len(kept) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, fst = Lexicon(model.learned), machine()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                scores = [model.score(events(t or "", lexicon, fst)) for t in batch.column(whole.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*kept, "toxicity"])

    fields = ", ".join(f"`{name}` {f.dataType.simpleString()}" for name, f in zip(kept, given.schema.fields))
    return given.mapInArrow(tidy(run), f"{fields}, toxicity double")


def held_out(id_col: str = "doc_id"):
    """Rows whose label is never learned from."""
    return F.coalesce(id_crc(F.col(id_col)) % 3 == 1, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = learn(docs, labels.where(~held_out()))
    out = score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
