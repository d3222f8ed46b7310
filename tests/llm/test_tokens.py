"""Counts against SentencePiece's unigram engine over the same pieces and scores, and against all paths."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orolog.llm import tokens as K

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def engine():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # unigram
    scores = K.load(PIECES).scores
    for p in model.pieces:
        if p.type == 1:
            p.score = scores[p.piece] / K.UNIT
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.fixture(scope="module")
def counter():
    return K.Counter(K.load(PIECES))


TEXTS = ["", " ", "   ", "Hello world", "  two  spaces\n\nnl\t", "日本語 é ü 𝒜𝒜 ﷽", "a" * 300, "don't stop-believing, e=mc^2; x_y(z)[0]", "▁already ▁▁ there", "\x00\x01 a\r\nb", "tail   ", "ÀÉÎõü ß", "\n\n\n", "…—“q”"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_equal_the_engine(engine, counter, text):
    assert counter.count(text) == len(engine.encode(text))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abcdeht ionrs  \n.,-éß日𝒜▁1", max_size=120))
def test_random_texts_equal_the_engine(engine, counter, text):
    assert counter.count(text) == len(engine.encode(text))


def test_words_equal_the_engine(engine, counter):
    r = random.Random(1)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    for _ in range(400):
        text = " ".join("".join(r.choices(syllables, k=r.randint(1, 5))).title() for _ in range(30))
        assert counter.count(text) == len(engine.encode(text))


def brute(scores: dict[str, float], text: str, unknown: float) -> set[int]:
    """Token counts of all best paths."""
    best: dict[int, tuple[float, set[int]]] = {0: (0.0, {0})}
    for end in range(1, len(text) + 1):
        ways = [(best[s][0] + scores[text[s:end]], {n + 1 for n in best[s][1]}) for s in range(end) if text[s:end] in scores]
        if text[end - 1] not in scores:
            ways.append((best[end - 1][0] + unknown, {n + len(text[end - 1].encode()) for n in best[end - 1][1]}))
        top = max(w[0] for w in ways)
        best[end] = (top, set().union(*(n for s, n in ways if s == top)))
    return best[len(text)][1]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text(alphabet="abc", min_size=1, max_size=4), st.integers(-9, -1), min_size=1, max_size=12), st.text(alphabet="abcdé", max_size=14))
def test_ties_stay_among_best_paths(scores, text):
    v = K.Vocabulary(scores, prefix=False)
    assert K.Counter(v).count(text) in brute(scores, text, v.unknown)


def test_on_a_tie_the_longer_last_piece_stays():
    v = K.Vocabulary({"a": -2, "b": -2, "ab": -3, "abb": -6, "bb": -4}, prefix=False)
    assert K.Counter(v).count("abb") == 2 if -3 - 2 > -6 else 1
    assert K.Counter(K.Vocabulary({"a": -2, "b": -2, "ab": -4}, prefix=False)).count("ab") == 1


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "Hello world", 7), (3, "word " * 50000, 8), (3, "x" * 100000, 9)], "doc_id long, text string, n_tokens int")
    got = [(r["doc_id"], r["n_tokens"]) for r in K.count_tokens(df, K.load(PIECES)).collect()]
    assert got[:3] == [(1, 0), (1, 0), (None, 2)] and got[3][1] == 50001 and got[4][1] > 5000
    assert K.count_tokens(df.limit(0), K.load(PIECES)).count() == 0
