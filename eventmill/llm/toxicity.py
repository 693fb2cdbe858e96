"""Toxicity by a weighted finite-state grammar of clauses.

Four small transducers read the words of a clause one after the other and are composed into one:
threats (a verb of harm followed closely by a target), negation (what stands within its scope is
negated), reported speech (what follows in the clause is reported), and targets (an insult in a
clause that names a target is aimed). The composed machine turns words into match kinds; a
document's score is the logistic of a bias plus the weighted counts of its matches. Words score
nothing by themselves: only matched clauses do.

Weights of match kinds are fitted on labelled documents by maximum a posteriori logistic regression
around the grammar's own weights, and word beginnings are added to the insults when labelled texts
show them in many different contexts in toxic documents and hardly in others (contexts, not
documents, so a group of near copies counts little). The fit uses at most ``SAMPLE`` labelled documents, the ones
with the smallest hashes of doc_id; rows with crc32(doc_id) mod 4 = 2 are never used. Scoring covers
every row and uses the text alone.

Python runs over Arrow batches of bounded size; the model is a few hundred words. Defined results: a
null or empty text scores the bias; a null doc_id is not held out; repeated rows are scored each;
labels that are null or neither 0 nor 1 are ignored, several labels of a document count as toxic if
one is; without labels the grammar's own weights stand; an empty table gives an empty result; other
columns are passed through by the stage and not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, table
from eventmill.session import written

SAMPLE = 20_000
REJECT = 0.3
SCOPE = 3
#: Word beginnings learned from labels: their lengths; least number of contexts, and as a share of
#: toxic documents; least ratio of their rates in toxic and other documents; most that are tried.
STEM = (4, 8)
CONTEXTS, CONTEXT_SHARE, RATE_RATIO, CONSIDERED = 5, 0.01, 20.0, 10_000
#: Matches of a kind count as the logarithm of one more, up to this many.
COUNT_LIMIT = 15

#: Word lists.
INSULTS = (
    "idiot idiots moron morons scum loser losers stupid pathetic worthless disgusting trash clown "
    "clowns imbecile imbeciles fool fools jerk creep vermin filth filthy garbage pig pigs coward "
    "cowards dumb dumbass bastard bastards bitch asshole assholes retard freak freaks parasite "
    "parasites degenerate subhuman lowlife scumbag crap shit fuck fucking"
).split()
HARM = (
    "kill hurt destroy beat burn hang shoot stab smash strangle murder crush punch choke slaughter "
    "bash break"
).split()
TARGETS = (
    "you your yours yourself u he him his she her they them their theirs these those this it all "
    "everyone people"
).split()
NEGATIONS = "not no never nobody nothing isn't aren't wasn't don't doesn't didn't ain't".split()
REPORTS = (
    "said says say told tells wrote writes called calls claimed claims quoted quotes reported "
    "reports alleged allegedly according stated states"
).split()

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n\r]")

#: Match kinds and the grammar's own weights, as log odds of a single match.
KINDS = {
    "aimed_insult": 4.0,
    "insult": 3.5,
    "aimed_threat": 4.0,
    "negated_insult": 0.5,
    "negated_threat": 0.3,
    "reported_insult": 1.0,
    "reported_threat": 1.0,
    "reported_negated_insult": 0.2,
    "reported_negated_threat": 0.2,
}
BIAS = -3.0


# --- transducers ------------------------------------------------------------------------------


@dataclass
class Transducer:
    """Steps (state, symbol) -> (state, symbol out, weight); any other symbol passes by ``rest``."""

    steps: dict[tuple[object, str], tuple[object, str, float]]
    rest: dict[object, object] = field(default_factory=dict)
    start: object = 0

    def step(self, state: object, symbol: str) -> tuple[object, str, float]:
        if (state, symbol) in self.steps:
            return self.steps[state, symbol]
        return self.rest.get(state, state), symbol, 0.0


def composed(first: Transducer, second: Transducer, symbols: set[str]) -> Transducer:
    """The transducer that feeds what ``first`` puts out to ``second``; weights add up."""
    start = (first.start, second.start)
    out = Transducer({}, start=start)
    open_, seen = [start], {start}
    while open_:
        a, b = state = open_.pop()
        for symbol in symbols:
            a2, between, w1 = first.step(a, symbol)
            b2, last, w2 = second.step(b, between)
            out.steps[state, symbol] = ((a2, b2), last, w1 + w2)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                open_.append((a2, b2))
    return out


def threats(scope: int = SCOPE) -> Transducer:
    """harm ... target, at most ``scope`` words apart, becomes a threat."""
    steps: dict = {(state, "harm"): (scope, "word", 0.0) for state in range(scope + 1)}
    for left in range(1, scope + 1):
        steps[left, "target"] = (0, "threat", 0.0)
    return Transducer(steps, {left: left - 1 for left in range(1, scope + 1)})


def negation(scope: int = SCOPE) -> Transducer:
    steps: dict = {(state, "negation"): (scope, "word", 0.0) for state in range(scope + 1)}
    for left in range(1, scope + 1):
        for kind in ("insult", "threat"):
            steps[left, kind] = (left - 1, f"negated_{kind}", 0.0)
    return Transducer(steps, {left: left - 1 for left in range(1, scope + 1)})


def reported_speech() -> Transducer:
    """What follows a verb of speech in its clause is reported."""
    steps: dict = {(state, "report"): (1, "word", 0.0) for state in (0, 1)}
    for kind in ("insult", "threat", "negated_insult", "negated_threat"):
        steps[1, kind] = (1, f"reported_{kind}", 0.0)
    return Transducer(steps)


def aim() -> Transducer:
    """An insult after a target of its clause is aimed; a threat names its target itself."""
    return Transducer(
        {
            (0, "target"): (1, "word", 0.0),
            (1, "insult"): (1, "aimed_insult", 0.0),
            (0, "threat"): (1, "aimed_threat", 0.0),
            (1, "threat"): (1, "aimed_threat", 0.0),
        }
    )


def grammar() -> Transducer:
    inputs = {"word", "insult", "harm", "target", "negation", "report"}
    machine = threats()
    for following in (negation(), reported_speech(), aim()):
        machine = composed(machine, following, inputs)
    for key, (state, kind, _) in list(machine.steps.items()):
        machine.steps[key] = (state, kind, KINDS.get(kind, 0.0))
    return machine


def word_classes() -> dict[str, str]:
    classes: dict[str, str] = {}
    for words, name in (
        (TARGETS, "target"),
        (REPORTS, "report"),
        (NEGATIONS, "negation"),
        (HARM, "harm"),
        (INSULTS, "insult"),
    ):
        classes.update(dict.fromkeys(words, name))
    return classes


class Matcher:
    """Scaled counts of match kinds of a text; words that begin with a learned stem are insults."""

    def __init__(self, stems=()):
        import ahocorasick

        self.classes = word_classes()
        self.stems = frozenset(stems)
        self.machine = grammar()
        self.kinds = list(KINDS)
        self.anchors = ahocorasick.Automaton()
        for stem in stems:
            self.anchors.add_word(stem, (len(stem), False))
        for word, name in self.classes.items():
            if name in ("insult", "harm") and word not in self.stems:
                self.anchors.add_word(word, (len(word), True))
        self.anchors.make_automaton()

    def symbol(self, word: str) -> str:
        found = self.classes.get(word)
        if found:
            return found
        for k in range(STEM[0], min(len(word), STEM[1]) + 1):
            if word[:k] in self.stems:
                return "insult"
        return "word"

    def clauses(self, text: str):
        """The clauses, lower-cased, that hold an anchor: a whole word, or a word's beginning."""
        lower = text.lower()
        reach = -1
        for end, (size, to_word_end) in self.anchors.iter(lower):
            start = end - size + 1
            if start <= reach or (start and lower[start - 1].isalnum()):
                continue
            if to_word_end and end + 1 < len(lower) and lower[end + 1].isalnum():
                continue
            left = max(lower.rfind(c, 0, start) for c in ".!?;:\n\r") + 1
            stop = CLAUSE_END.search(lower, end + 1)
            reach = (stop.start() if stop else len(lower)) - 1
            yield lower[left : reach + 1]

    def counts(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(self.kinds))
        for clause in self.clauses(text) if text else ():
            state = self.machine.start
            for m in WORD.finditer(clause):
                symbol = self.symbol(m[0].replace("’", "'"))
                state, kind, _ = self.machine.step(state, symbol)
                if kind in KINDS:
                    out[self.kinds.index(kind)] += 1
        return np.log2(1.0 + np.minimum(out, COUNT_LIMIT))


@lru_cache(maxsize=4)
def matcher_of(learned: tuple[str, ...]) -> Matcher:
    """One matcher per worker and word list."""
    return Matcher(learned)


# --- learning ---------------------------------------------------------------------------------


@dataclass
class Model:
    learned: list[str]
    weights: np.ndarray
    bias: float

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(counts @ self.weights + self.bias)))


def held_out(doc_id: Column | str) -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # Broadcast: at most ``most`` rows of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+"), F.lit(0))


def _stems(words: Column) -> Column:
    """The different word beginnings of the stem lengths."""
    long = F.filter(words, lambda w: F.char_length(w) >= STEM[0])
    return F.array_distinct(F.flatten(F.transform(long, _beginnings)))


def _beginnings(word: Column) -> Column:
    lengths = F.sequence(F.lit(STEM[0]), F.least(F.char_length(word), F.lit(STEM[1])))
    return F.transform(lengths, lambda k: F.substr(word, F.lit(1), k))


def learned_stems(sample: DataFrame) -> list[str]:
    """Word beginnings that stand in many contexts in toxic texts of the sample, hardly in others."""
    sizes = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    least = max(CONTEXTS, CONTEXT_SHARE * toxic)
    split = sample.select("toxic", _words(F.col("text")).alias("words"))
    bad, good = split.where("toxic = 1"), split.where("toxic = 0")
    frequent = (
        bad.select(F.explode(_stems(F.col("words"))).alias("stem"))
        .groupBy("stem")
        .agg(F.count("*").alias("in_toxic"))
        .where(F.col("in_toxic") >= least)
        .orderBy(F.desc("in_toxic"), "stem")
        .limit(CONSIDERED)
    )
    frequent = written(frequent, "stems")  # broadcast below: at most CONSIDERED short words
    in_clean = (
        good.select(F.explode(_stems(F.col("words"))).alias("stem"))
        .join(F.broadcast(frequent), "stem")
        .groupBy("stem")
        .agg(F.count("*").alias("in_clean"))
    )
    pairs = F.arrays_zip(
        F.col("words").alias("word"), F.slice("words", 2, 1 << 30).alias("following")
    )
    contexts = (
        bad.select(F.explode(pairs).alias("p"))
        .where(F.char_length("p.word") >= STEM[0])
        .select(F.explode(_beginnings(F.col("p.word"))).alias("stem"), "p.following")
        .join(F.broadcast(frequent.select("stem")), "stem")
        .distinct()
        .groupBy("stem")
        .agg(F.count("*").alias("contexts"))
    )
    rows = (
        frequent.join(in_clean, "stem", "left")
        .join(contexts, "stem")
        .where(F.col("contexts") >= least)
        .select("stem", "in_toxic", F.coalesce("in_clean", F.lit(0)).alias("in_clean"))
        .collect()
    )
    chosen: list[str] = []
    for row in sorted(rows, key=lambda r: (len(r["stem"]), -r["in_toxic"], r["stem"])):
        ratio = ((row["in_toxic"] + 0.5) / (toxic + 1)) / ((row["in_clean"] + 0.5) / (clean + 1))
        if ratio >= RATE_RATIO and not any(row["stem"].startswith(c) for c in chosen):
            chosen.append(row["stem"])
    return chosen


def fit(counts: np.ndarray, toxic: np.ndarray, spread: float = 2.0) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic regression with a normal prior around the grammar's weights."""
    centre = np.array([*KINDS.values(), BIAS])
    weights = centre.copy()
    x = np.hstack([counts, np.ones((len(counts), 1))])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - toxic) + (weights - centre) / spread**2
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(centre)) / spread**2
        step = np.linalg.solve(curve, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    sample = written(labelled_sample(docs, labels, most), "labelled")
    learned = learned_stems(sample)
    words = tuple(learned)

    @F.pandas_udf("array<double>")
    def counts_of(texts: pd.Series) -> pd.Series:
        matcher = matcher_of(words)
        return pd.Series([matcher.counts(t).tolist() for t in texts], dtype=object)

    # One text of each doc_id, so that repeated rows do not exceed the bound: that with the least
    # hash, whatever the order of the rows.
    single = sample.groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")
    )
    rows = single.select("doc_id", "toxic", counts_of("text").alias("counts")).orderBy("doc_id").collect()
    if not rows:
        return Model(learned, np.array(list(KINDS.values())), BIAS)
    counts = np.array([r["counts"] for r in rows])
    weights, bias = fit(counts, np.array([float(r["toxic"]) for r in rows]))
    return Model(learned, weights, bias)


def toxicity_score(model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1."""
    words = tuple(model.learned)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        matcher = matcher_of(words)
        return pd.Series(model.score(np.array([matcher.counts(t) for t in texts])))

    return score(text.cast("string"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that score below ``REJECT``."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(model, F.col("text")) < REJECT)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        toxicity_score(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


QUERIES = {"op6_toxicity": op6_toxicity}

ORACLE: dict[str, str] = {}
