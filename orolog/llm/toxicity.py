"""Toxicity by weak supervision.

Voters are short lexicons, patterns, and words or word beginnings that a test finds in toxic training texts far
more often than in others. A generative label model explains their votes on the training texts by a hidden label:
each voter fires at a rate of its own on toxic and on other texts, and these rates depend on whether the voter next to
it in a forest of correlated voters fires. Expectation maximisation fits the prior, all rates and the forest to the
votes alone; labels choose the voters and the point from which it starts, and have no part in the posterior of a text.
The posterior labels train a logistic regression over the voters and all tested words, which scores every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from math import exp

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.llm._shared import held_out, map_rows

#: Expected numbers of labelled training texts that the model is fitted on (fewer where there are fewer).
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
#: Words and word beginnings that the regression takes, and those of them that vote.
MAX_FEATURES, MAX_VOTERS = 1024, 128
#: Nats by which a word's share of toxic texts must exceed chance (a Chernoff bound, beside the number of words tested).
EVIDENCE = 10.0
PREFIXES = (4, 5, 6, 7)
#: Probability of its training label that a text starts with in the label model.
START = 0.9
ROUNDS = 400
#: Rounds in which the forest of correlated voters is worked out anew.
FOREST_ROUNDS = (0, 6, 12, 20, 30, 60, 100)
#: Nats that a dependence between two voters has to explain over all texts.
EDGE = 12.0
#: Texts that a rate under a rarely seen state of the voter beside it borrows from the voter's own rate.
BORROWED = 4.0
RIDGE = 0.05
TOXIC_FROM = 0.7

# English words by kind of abuse.
LEXICONS = {
    "insult": "idiot idiots moron morons stupid imbecile fool dumb dumbass loser losers clown pathetic worthless scum trash garbage ugly retard retarded lowlife cretin halfwit",
    "disgust": "disgusting vile filthy repulsive revolting sickening vermin subhuman",
    "profanity": "fuck fucking fucked shit shitty bullshit bitch bastard asshole dick cunt crap whore slut",
    "threat": "kill murder strangle stab shoot hang rape exterminate",
}
_LEXICON = {w: name for name, line in LEXICONS.items() for w in line.split()}
_PATTERNS = {
    "you are": re.compile(r"\b(?:you|u|ur|you're|youre)\s+(?:are\s+)?(?:an?\s+|so\s+|such\s+an?\s+)?(?:idiot|moron|fool|loser|clown|stupid|pathetic|worthless|disgusting|trash|scum)\b"),
    "masked": re.compile(r"\b(?:f[*#@]+c?k|sh[*#@!1]t|b[*#@!1]tch|a[*#@$]{2}hole)"),
    "go away": re.compile(r"\b(?:shut up|go to hell|drop dead|get lost|screw you)\b"),
    "bangs": re.compile(r"!!"),
}
_PATTERN_HINT = ("you", "u ", "*", "#", "@", "!", "shut", "hell", "dead", "lost", "screw")
_WORDS = re.compile(r"\w+")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")
FIXED = (*LEXICONS, *_PATTERNS, "shouting")


def words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def tokens(text: str | None) -> set[str]:
    """Words, and the beginnings of longer ones followed by *."""
    found = words(text)
    return found | {f"{w[:n]}*" for w in found for n in PREFIXES if len(w) > n}


def fixed_votes(text: str, found: set[str]) -> list[int]:
    """Places in FIXED of the lexicons and patterns that fire."""
    out = {FIXED.index(_LEXICON[w]) for w in found & _LEXICON.keys()}
    low = text.lower()
    if any(h in low for h in _PATTERN_HINT):
        out |= {FIXED.index(name) for name, p in _PATTERNS.items() if p.search(low)}
    if any(w.isascii() for w in found) and _SHOUT.search(text) and len(_SHOUT.findall(text)) * 4 > len(found):
        out.add(FIXED.index("shouting"))
    return sorted(out)


@dataclass
class Model:
    """Places of the features (FIXED first, then the tested words) with their weights."""

    features: dict[str, int] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    bias: float = -3.0

    def fired(self, text: str | None) -> list[int]:
        found, get = words(text), self.features.get
        out = set(fixed_votes(text or "", found))
        for w in found:
            if (k := get(w)) is not None:
                out.add(k)
            for n in PREFIXES:
                if len(w) > n and (k := get(f"{w[:n]}*")) is not None:
                    out.add(k)
        return sorted(out)

    def score(self, fired: list[int]) -> float:
        x = self.bias + sum(self.weights[k] for k in fired)
        return 1 / (1 + exp(-min(30.0, max(-30.0, x))))


def forest(votes: np.ndarray, y: np.ndarray, texts: np.ndarray | float = 1.0) -> list[int]:
    """For each voter the voter that it depends on most, given the label (-1: none): a maximum spanning forest by conditional mutual information. Each row stands for so many texts."""
    m = votes.shape[1]
    nats = np.zeros((m, m))
    for w in (texts * y, texts * (1 - y)):
        size = w.sum() + 1e-9
        both, one = votes.T @ (votes * w[:, None]) / size, w @ votes / size
        for p, a, b in ((both, one[:, None], one), (one[:, None] - both, one[:, None], 1 - one), (one - both, 1 - one[:, None], one), (1 - one[:, None] - one + both, 1 - one[:, None], 1 - one)):
            p = np.clip(p, 1e-12, 1)
            nats += size * p * np.log(p / np.clip(a * b, 1e-12, 1))
    np.fill_diagonal(nats, 0)
    parent, best, free = [-1] * m, np.full(m, EDGE), set(range(m))
    while free:
        j = max(free, key=lambda k: (parent[k] >= 0, best[k] if parent[k] >= 0 else 0, -k))  # a tree is finished before the next begins
        free.discard(j)
        for k in free:
            if nats[j, k] > best[k]:
                best[k], parent[k] = nats[j, k], j
    return parent


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posterior label of each text, firing rates on toxic and on other texts, and each voter's weight.

    `votes` is texts by voters, 1 where a voter fires. `start` are labels from which the first rates are taken, so that
    the hidden label means what they mean; after that the model sees votes only. A voter's weight is 1 over 1 plus the
    sum of its correlations, given the label, with its neighbours in the forest: copies of one voter count about once.
    """
    m = votes.shape[1]
    votes, at, texts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)  # texts with the same votes have one posterior
    y = np.bincount(at.ravel(), np.where(start > 0.5, START, 1 - START), len(votes)) / texts
    parent, on, off = [-1] * m, np.zeros(m), np.zeros(m)
    for k in range(rounds if len(votes) else 0):
        if k in FOREST_ROUNDS:
            parent = forest(votes, y, texts)
            beside = np.where(np.array(parent) >= 0, votes[:, parent], 0.0)
        odds = np.full(len(votes), np.log(((texts * y).sum() + 1) / ((texts * (1 - y)).sum() + 1)))
        for w, sign in ((texts * y, 1), (texts * (1 - y), -1)):
            size, fired, seen, both = w.sum(), w @ votes, w @ beside, w @ (votes * beside)
            rate = (fired + 0.1) / (size + 1)
            with_it = (both + BORROWED * rate) / (seen + BORROWED)
            without = (fired - both + BORROWED * rate) / (size - seen + BORROWED)
            p = np.clip(np.where(beside > 0, with_it, without), 1e-6, 1 - 1e-6)
            odds += sign * np.where(votes > 0, np.log(p), np.log1p(-p)).sum(1)
            on, off = (rate, off) if sign > 0 else (on, rate)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = k > max(FOREST_ROUNDS) and np.abs(new - y).max() < 1e-5
        y = new
        if done:
            break
    y, votes = y[at.ravel()], votes[at.ravel()]
    residual = votes - (np.outer(y, on) + np.outer(1 - y, off))
    spread = np.sqrt((residual**2).mean(0)) + 1e-9 if len(votes) else np.ones(m)
    shared = np.zeros(m)
    for j, i in enumerate(parent):
        if i >= 0:
            c = max(0.0, float((residual[:, i] * residual[:, j]).mean() / (spread[i] * spread[j])))
            shared[i], shared[j] = shared[i] + c, shared[j] + c
    return y, on, off, 1 / (1 + shared)


def regression(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; the bias isn't penalised."""
    n, m = x.shape
    full = np.hstack([x, np.ones((n, 1))])
    w, penalty = np.zeros(m + 1), np.append(np.full(m, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (p - y) + penalty * w
        curve = (full * (p * (1 - p) + 1e-6)[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def _evidence(a: Column, both: Column, share: float) -> Column:
    """Nats by which a of `both` exceeds the share that chance gives."""
    f = a / both
    rest = F.when(f < 1, (1 - f) * F.log((1 - f) / (1 - share))).otherwise(0.0)
    return F.when(f > share, both * (f * F.log(f / share) + rest)).otherwise(0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit a model to the labelled texts that are not held out.

    Rows of ``labels`` without an id or a label are left out; of several labels of one id the highest counts, of
    several rows of one id any. Without toxic or without other texts the fixed lexicons score alone.
    """
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    if not sizes.get(True) or not sizes.get(False):
        return Model({}, [4.0] * len(LEXICONS) + [0.0] * (len(FIXED) - len(LEXICONS)))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2**40))
    part = lambda flag, most: (F.col("toxic") == int(flag)) & (place < F.lit(int(min(1.0, most / sizes[flag]) * 2**40)))
    chosen = known.where(part(True, SAMPLE_TOXIC) | part(False, SAMPLE_CLEAN))  # about SAMPLE_TOXIC + SAMPLE_CLEAN ids
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("text is not null").join(F.broadcast(chosen), "doc_id")

    def split() -> Callable[..., list[list]]:
        def step(toxic: list, texts: list) -> list[list]:
            found = [(t, w) for t, text in zip(toxic, texts, strict=True) for w in tokens(text)]
            return [[x[0] for x in found], [x[1] for x in found]]

        return step

    drawn = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_all = drawn.get(1, 0), sum(drawn.values())
    if not 0 < n_toxic < n_all:
        return Model({}, [4.0] * len(LEXICONS) + [0.0] * (len(FIXED) - len(LEXICONS)))
    counted = map_rows(texts.select("toxic", "text"), "toxic int, word string", split).groupBy("word").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    tested = counted.withColumn("nats", _evidence(F.col("a"), F.col("n"), n_toxic / n_all)).where(F.col("nats") >= EVIDENCE)
    listed = [r["word"] for r in tested.orderBy(F.desc("nats"), "word").limit(MAX_FEATURES).collect()]
    model = Model({w: len(FIXED) + i for i, w in enumerate(listed)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES words at most

    def vote() -> Callable[..., list[list]]:
        return lambda ids, toxic, texts: [ids, toxic, [shared.value.fired(t) for t in texts]]

    kind = dict(texts.dtypes)["doc_id"]
    votes = map_rows(texts.select("doc_id", "toxic", "text"), f"doc_id {kind}, toxic int, fired array<int>", vote)
    rows = votes.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("fired").alias("fired")).orderBy("doc_id").collect()  # the sample's ids
    x = np.zeros((len(rows), len(FIXED) + len(listed)))
    for i, r in enumerate(rows):
        x[i, r["fired"]] = 1
    gold = np.array([float(r["toxic"]) for r in rows])
    y, *_ = label_model(x[:, : len(FIXED) + MAX_VOTERS], gold)
    w, bias = regression(x, y)
    natural, drawn_odds = sizes[True] / sizes[False], max(1e-9, gold.sum()) / max(1e-9, (1 - gold).sum())
    model.weights, model.bias = w.tolist(), bias + float(np.log(natural / drawn_odds))
    return model


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Toxicity of every row's whole text.

    Returns ``doc_id, score, n_fired``, one row for each row of ``df``; score is from 0 to 1. Null and empty
    texts get the score of a text in which nothing fires; repeated rows are scored alike; an empty table gives
    no rows. Only the named columns are read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("score double, n_fired long").fields])

    def make() -> Callable[..., list[list]]:
        m = shared.value

        def step(ids: list, texts: list) -> list[list]:
            fired = [m.fired(t) for t in texts]
            return [ids, [m.score(f) for f in fired], [len(f) for f in fired]]

        return step

    return map_rows(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), schema, make)
