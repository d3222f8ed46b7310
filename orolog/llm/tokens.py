"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character; the dynamic programme carries, for
each position, the best score and the number of tokens of the path that has it, and nothing to trace it back.
The rules are those of the unigram tokenizer: a path replaces another only if its score is greater, pieces being
tried from earlier starts on (so on a tie the longer last piece stays); a character that is no piece itself costs
the lowest score less UNKNOWN_COST, and counts as its UTF-8 bytes where the vocabulary falls back to bytes.

No piece crosses the place where a space follows another character, or touches a line feed that is in no piece.
Paths are therefore counted chunk by chunk between such places, and the counts of chunks are kept: with the exact
(integer) scores used here the sum equals that of the whole text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orolog.llm._shared import map_rows

SPACE = "▁"
UNKNOWN_COST = 10
#: Zipf scores are whole multiples of 1/1024 nat, so that sums are exact and ties are true ties.
UNIT = 1024
#: Chunks whose counts a task keeps; the table starts anew beyond that.
CACHE_CHUNKS = 500_000


@dataclass
class Vocabulary:
    """Pieces with scores in units; `bytes` tells whether unknown characters fall back to bytes."""

    scores: dict[str, float]
    bytes: bool = True
    prefix: bool = True
    unknown: float = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.unknown = min(self.scores.values(), default=0) - UNKNOWN_COST * UNIT
        self.longest = max(map(len, self.scores), default=1)
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        if any(crossing.search(p) for p in self.scores):
            raise ValueError("a piece goes on beyond a space")


def zipf(ranked: list[str]) -> dict[str, float]:
    """Scores of pieces in order of frequency: the log-probability of each under Zipf's law, in units."""
    total = sum(1 / r for r in range(1, len(ranked) + 1))
    return {p: -round(UNIT * log(r * total)) for r, p in enumerate(ranked, 1)}


def load(path: str, stored_scores: bool = False) -> Vocabulary:
    """Vocabulary of a SentencePiece file; scores by rank under Zipf's law, or as stored (for unigram models)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = [sp.id_to_piece(i) for i in ids]
    scores = {p: sp.get_score(i) * UNIT for p, i in zip(pieces, ids, strict=True)} if stored_scores else zipf(pieces)
    return Vocabulary(scores, any(sp.is_byte(i) for i in range(sp.get_piece_size())))


class Counter:
    """Counts tokens of texts; made where it is used."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for p, s in vocabulary.scores.items():
            self.automaton.add_word(p, (len(p), s))
        if vocabulary.scores:
            self.automaton.make_automaton()
        self.single = frozenset(p for p in vocabulary.scores if len(p) == 1)
        stop = "" if any("\n" in p for p in vocabulary.scores) else r"\n"
        self.chunks = re.compile(rf"{SPACE}+[^{SPACE}{stop}]*|[^{SPACE}{stop}]+" + (r"|\n" if stop else ""))
        self.known: dict[str, int] = {}

    def path(self, chunk: str) -> int:
        """Tokens of the best path through a chunk. Only as many positions are held as the longest piece has characters."""
        size = self.v.longest + 1
        best, count = [0.0] * size, [0] * size
        single, unknown = self.single, self.v.unknown
        ending = iter(self.automaton.iter(chunk)) if self.v.scores else iter(())
        match = next(ending, None)
        for end, c in enumerate(chunk):
            at, before = (end + 1) % size, end % size
            top, tokens, start = None, 0, 0
            while match is not None and match[0] == end:
                length, score = match[1]
                came = (end + 1 - length) % size
                s = best[came] + score
                if top is None or s > top or (s == top and end + 1 - length < start):
                    top, tokens, start = s, count[came] + 1, end + 1 - length
                match = next(ending, None)
            if c not in single and (top is None or best[before] + unknown > top):
                top, tokens = best[before] + unknown, count[before] + (len(c.encode("utf-8", "surrogatepass")) if self.v.bytes else 1)
            best[at], count[at] = top, tokens
        return count[len(chunk) % size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if self.v.prefix:
            text = SPACE + text
        known, total = self.known, 0
        if len(known) > CACHE_CHUNKS:
            known.clear()
        for chunk in self.chunks.findall(text):
            n = known.get(chunk)
            if n is None:
                n = self.path(chunk)
                if len(chunk) <= 64:
                    known[chunk] = n
            total += n
        return total


#: The counter that this process made last, by its vocabulary's key: tasks of one process share its chunks.
_made: dict[str, Counter] = {}


def _counter(key: str, shared) -> Counter:
    if key not in _made:
        _made.clear()
        _made[key] = Counter(shared.value)
    return _made[key]


def count_tokens(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every row's whole text.

    Returns ``doc_id, n_tokens, n_chars``, one row for each row of ``df``. Null and empty texts have no tokens;
    texts of any length are read whole; repeated rows count alike; an empty table gives no rows. Only the named
    columns are read.
    """
    shared, key = df.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex  # the vocabulary's pieces
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("n_tokens long, n_chars long").fields])

    def make() -> Callable[..., list[list]]:
        counter = _counter(key, shared)
        return lambda ids, texts: [ids, [counter.count(t) for t in texts], [len(t or "") for t in texts]]

    return map_rows(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), schema, make)
