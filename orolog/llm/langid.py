"""Language identification: script ranges narrow the candidates, Viterbi over words labels spans.

A model has, for each language, the share of its letters in each script and conditional character trigram
counts. A word's script decides which languages are candidates, and only they are scored: the score is the
log-probability of the word's characters. Viterbi with a switching penalty labels the words of a text, so that a
mixed text falls into spans of one language each.

Texts of one language are the common case: if the two other languages that gain most over any stretch of words
gain no more than the penalty together, no switch can pay (a path from one to the other has two gains for one
penalty), and the running sums show that without the word-by-word programme.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.llm._shared import held, keep_rows, map_batches, map_rows

UNDETERMINED = "und"
#: Expected number of labelled documents of each language that the model is fitted on (fewer where there are fewer).
SAMPLE_DOCS = 400
#: Most frequent character n-grams kept in a model.
MAX_GRAMS = 200_000
#: Nats that a change of language costs.
SWITCH = 12.0
#: A language is a candidate for words of a script that holds this share of its letters.
SCRIPT_SHARE = 0.01
SMOOTH = 0.5
#: Scores and facts of words that a task keeps; its tables start anew beyond that.
CACHE_CELLS = 2_400_000

# First code points of script ranges and the script that begins there ('' for none of these).
_SCRIPTS = (
    (0x0041, "Latin"), (0x0250, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, ""),
    (0x0750, "Arabic"), (0x0780, ""), (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, ""),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, ""), (0x1780, "Khmer"), (0x1800, ""), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, ""), (0x2DE0, "Cyrillic"), (0x2E00, ""), (0x3040, "Kana"), (0x3100, ""), (0x3130, "Hangul"), (0x3190, ""), (0x3400, "Han"),
    (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, ""), (0x20000, "Han"), (0x32000, ""),
)
_FIRST, _NAMES = [x[0] for x in _SCRIPTS], [x[1] for x in _SCRIPTS]
_WORDS = re.compile(r"[^\W\d_]+")


def script(c: str) -> str:
    at = bisect_right(_FIRST, ord(c))
    return _NAMES[at - 1] if at else ""


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


@dataclass
class Model:
    languages: list[str]
    grams: dict[str, dict[int, int]]  # counts by place of the language, of one to three characters, words padded by a space
    scripts: list[dict[str, float]]  # share of letters by script

    def __post_init__(self) -> None:
        self.alphabet = max(2, sum(len(g) == 1 for g in self.grams))
        self.able: dict[str, list[int]] = {}
        self.known: dict[str, dict[str, tuple[float, ...]]] = {}

    def candidates(self, kind: str) -> list[int]:
        """Places of the languages that use a script."""
        if kind not in self.able:
            self.able[kind] = [k for k, s in enumerate(self.scripts) if s.get(kind, 0.0) >= SCRIPT_SHARE]
        return self.able[kind]

    def logs(self, three: str, kind: str) -> tuple[float, ...]:
        """Log-probability in each candidate of the last of three characters after the other two; kept."""
        last, before = self.grams.get(three, {}), self.grams.get(three[:2], {})
        out = tuple(log((last.get(k, 0) + SMOOTH) / (before.get(k, 0) + SMOOTH * self.alphabet)) for k in self.candidates(kind))
        known = self.known.setdefault(kind, {})
        if len(known) > MAX_GRAMS:
            known.clear()
        known[three] = out
        return out

    def score(self, word: str) -> list[float]:
        """Log-probability of the word in each language; one whose script it isn't gets the lowest of the candidates less one a character."""
        kind, scores = self.scored(word)
        out = [min(scores, default=0.0) - len(word) * bool(scores)] * len(self.languages)
        for k, x in zip(self.candidates(kind), scores, strict=True):
            out[k] = x
        return out

    def scored(self, word: str) -> tuple[str, list[float]]:
        """The word's script, and its log-probability in each candidate of that script; no other language is looked at."""
        kind = script(word[0]) or next((k for c in word if (k := script(c))), "")
        if not self.candidates(kind):
            return kind, []
        padded, known = f" {word} ", self.known.setdefault(kind, {})
        parts = [known.get(padded[i : i + 3]) or self.logs(padded[i : i + 3], kind) for i in range(len(word))]
        return kind, list(map(sum, zip(*parts, strict=True)))


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> list[tuple[int, int, int]]:
    """Spans (first, end, language) of the best labelling of words; ties go to staying and to the earlier language."""
    n, width = scores.shape
    if not n:
        return []
    total = scores.sum(0)
    best = int(np.argmax(total))
    gain = np.cumsum(scores - scores[:, [best]], axis=0)
    low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros((1, width)), gain[:-1]]), axis=0), 0)
    if np.sort((gain - low).max(0))[-2:].clip(0).sum() <= switch:
        return [(0, n, best)]
    back = np.empty((n, width), dtype=np.int32)
    at = scores[0].tolist()
    for i, row in enumerate(scores.tolist()):
        if i == 0:
            continue
        top = max(range(width), key=at.__getitem__)
        moved = at[top] - switch
        line = back[i]
        new = []
        for k in range(width):
            stay = at[k] >= moved
            line[k] = k if stay else top
            new.append((at[k] if stay else moved) + row[k])
        at = new
    k, path = max(range(width), key=at.__getitem__), []
    for i in range(n - 1, -1, -1):
        path.append(k)
        if i:
            k = int(back[i, k])
    path.reverse()
    cuts = [0, *(i for i in range(1, n) if path[i] != path[i - 1]), n]
    return [(a, b, path[a]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Rows:
    """Rows of numbers as an array that grows by doubling, so that adding some to many doesn't copy the many."""

    def __init__(self, width: int, kind: type) -> None:
        self.array = np.zeros((1024, width), dtype=kind)
        self.new: list[tuple] = []
        self.n = 0

    def __len__(self) -> int:
        return self.n + len(self.new)

    def all(self) -> np.ndarray:
        if self.new:
            if len(self) > len(self.array):
                more = np.zeros((2 * len(self), self.array.shape[1]), dtype=self.array.dtype)
                more[: self.n] = self.array[: self.n]
                self.array = more
            self.array[self.n : len(self)] = self.new
            self.n, self.new = len(self), []
        return self.array


class Labeller:
    """Scores words once, and labels texts. A script's words have a table of their own, as wide as the script has candidates."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.read = 0.0  # share of the letters of the last text that are in words of a script that some language uses
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.kinds: list[str] = [""]  # the first for words that no language reads
        self.tables: list[Rows] = [Rows(1, np.float64)]  # scores of each script's words
        self.facts = Rows(3, np.int64)  # of each word: place of its script, place in that table, letters
        self.cells = 0

    def _add(self, word: str) -> None:
        letters = len(word) if word.isalpha() else sum(map(str.isalpha, word))
        kind, scores = self.model.scored(word) if letters else ("", [])
        k = 0
        if scores:
            if kind not in self.kinds[1:]:
                self.kinds.append(kind)
                self.tables.append(Rows(len(scores), np.float64))
            k = self.kinds.index(kind, 1)
            self.tables[k].new.append(scores)
        self.number[word] = len(self.facts)
        self.facts.new.append((k, len(self.tables[k]) - 1 if k else 0, letters))
        self.cells += len(scores) + 4

    def numbers(self, listed: list[str]) -> np.ndarray:
        if self.cells > CACHE_CELLS:
            self.forget()
        found = list(map(self.number.get, listed))
        if None in found:
            for w in listed:
                if w not in self.number:
                    self._add(w)
            found = list(map(self.number.get, listed))
        return self.facts.all()[np.array(found, dtype=np.int64)]

    def scores(self, facts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Scores of a text's words in the candidates of its scripts, and these candidates.

        A language that doesn't use a word's script gets the lowest of the others less one a character; words that no
        language reads score nothing in any.
        """
        present = [k for k in np.unique(facts[:, 0]).tolist() if k]
        if len(present) == 1 and facts[:, 0].all():
            return self.tables[present[0]].all()[facts[:, 1]], self.model.candidates(self.kinds[present[0]])
        columns = sorted({c for k in present for c in self.model.candidates(self.kinds[k])}) or [0]
        out = np.zeros((len(facts), len(columns)))
        for k in present:
            at = np.flatnonzero(facts[:, 0] == k)
            own = self.tables[k].all()[facts[at, 1]]
            out[at] = (own.min(1) - facts[at, 2])[:, None]
            out[np.ix_(at, np.searchsorted(columns, self.model.candidates(self.kinds[k])))] = own
        return out, columns

    def label(self, text: str | None) -> tuple[str, float, list[tuple[int, int, int]]]:
        """Language of most letters, its score, and the spans (first word, end, language)."""
        facts = self.numbers(words(text))
        letters = facts[:, 2]
        total = int(letters.sum())
        if not total or not self.model.languages:
            return UNDETERMINED, 0.0, []
        self.read = float(letters[facts[:, 0] > 0].sum() / total)
        scores, columns = self.scores(facts)
        spans = viterbi(scores)
        if len(self.model.languages) == 1:
            return self.model.languages[0], 1.0, [(a, b, 0) for a, b, _ in spans]
        share = [0] * len(columns)
        for a, b, k in spans:
            share[k] += int(letters[a:b].sum())
        best = max(range(len(share)), key=share.__getitem__)
        own = np.concatenate([scores[a:b] for a, b, k in spans if k == best]).sum(0)
        lead = own[best] - np.delete(own, best).max() if len(own) > 1 else float(share[best]) * bool(self.read)  # as if another language had the lowest score
        return self.model.languages[columns[best]], share[best] / total / (1 + exp(-min(50.0, max(-50.0, lead)))), [(a, b, columns[k]) for a, b, k in spans]

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Character spans of one language each, from the first letter of a span to its last."""
        at = [m.span() for m in _WORDS.finditer(text)]
        _, _, found = self.label(text)
        return [(at[a][0], at[b - 1][1], self.model.languages[k]) for a, b, k in found] if len(at) == (found[-1][1] if found else 0) else []


def sample(labelled: DataFrame, per_language: int = SAMPLE_DOCS) -> tuple[list[str], DataFrame]:
    """The languages, and the rows ``(doc_id, lang, text)`` of which about `per_language` of each stay, chosen by a hash of the id, or of the text where there is none."""
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()  # the languages, which the model keeps as well
    counts = F.broadcast(labelled.sparkSession.createDataFrame([tuple(r) for r in found], "lang string, n long"))
    place = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64(F.col("doc_id").cast("string"))), F.lit(2**40))
    chosen = labelled.join(counts, "lang").where(place < F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n")) * 2**40)
    return sorted(r["lang"] for r in found), chosen.select("doc_id", "lang", "text")


def train(labelled: DataFrame) -> Model:
    """Fit a model to ``(doc_id, lang, text)``. Rows without lang or text are left out; no rows give a model that knows no language."""
    languages, chosen = sample(labelled.where("lang is not null and text is not null"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w, n in Counter(words(text)).items():
                    padded = f" {w} "
                    for c in w:
                        seen[lang, c] += n
                    for i in range(len(padded) - 1):
                        seen[lang, padded[i : i + 2]] += n
                        seen[lang, padded[i : i + 3]] += n * (i < len(padded) - 2)
                if len(seen) > 500_000:
                    yield out()
                    seen.clear()
        yield out()

    grams = map_batches(chosen.select("lang", "text"), count, "lang string, gram string, n long").where("n > 0")
    if not languages:
        return Model([], {}, [])
    place = {x: k for k, x in enumerate(languages)}
    counted = grams.groupBy("gram", "lang").agg(F.sum("n").alias("n")).groupBy("gram").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("cells"))  # a cell for each language
    rows = counted.orderBy(F.desc("all"), "gram").limit(MAX_GRAMS).select("gram", "cells").collect()
    table = {r["gram"]: {place[c["lang"]]: c["n"] for c in r["cells"]} for r in rows}
    scripts: list[dict[str, float]] = []
    for k in range(len(languages)):
        by: Counter = Counter()
        for g, n in table.items():
            if len(g) == 1:
                by[script(g)] += n.get(k, 0)
        scripts.append({s: x / max(1, sum(by.values())) for s, x in by.items()})
    return Model(languages, table, scripts)


def _labeller(key: str, shared) -> Labeller:
    """The labeller that tasks of this process share for one model, with its words."""
    return held(key, lambda: Labeller(shared.value))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every row's whole text.

    Returns ``doc_id, lang_pred, score, n_spans``, one row for each row of ``df``. Null texts and texts without
    a letter are 'und' with score 0, as is every text under a model that knows no language; a text in scripts
    that no language uses gets a low score; repeated rows are labelled alike; an empty table gives no rows.
    Only the named columns are read.
    """
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("lang_pred string, score double, n_spans long").fields])
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # MAX_GRAMS n-grams at most

    def make() -> Callable[..., list[list]]:
        labeller = _labeller(key, shared)

        def step(ids: list, texts: list) -> list[list]:
            rows = []
            for i, t in zip(ids, texts, strict=True):
                lang, score, spans = labeller.label(t)
                rows.append((i, lang, score, len(spans)))
            return [list(x) for x in zip(*rows, strict=True)]

        return step

    return map_rows(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), schema, make)


def keep_identified(df: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a language with a score of `least`; all columns as they are.

    Letters of scripts that no language of the model uses belong to none: the score counts for the share of the others.
    """
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def make() -> Callable[[str | None], bool]:
        labeller = _labeller(key, shared)

        def good(text: str | None) -> bool:
            lang, score, _ = labeller.label(text)  # sets labeller.read
            return lang != UNDETERMINED and score >= least and score * labeller.read >= least

        return good

    return keep_rows(df, text_col, make)
