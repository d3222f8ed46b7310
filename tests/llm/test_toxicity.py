"""The label model on votes of known quality, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from orolog.llm import toxicity as X


def test_label_model_finds_rates_and_counts_copies_once():
    """From votes alone: three signs that fire apart are what a hidden label can be told from; their copies add nothing."""
    r = np.random.default_rng(1)
    y = (r.random(8000) < 0.3).astype(float)
    rates = [(0.6, 0.02), (0.4, 0.05), (0.3, 0.3), (0.5, 0.03)]
    votes = np.stack([np.where(y == 1, r.random(8000) < a, r.random(8000) < b) for a, b in rates], axis=1).astype(float)
    alone, *_ = X.label_model(votes, y)
    votes = np.hstack([votes, votes[:, [0]], votes[:, [0]]])  # two copies of the first
    post, on, off, weight = X.label_model(votes, y)
    assert np.allclose(on[:4], [a for a, _ in rates], atol=0.07) and np.allclose(off[:4], [b for _, b in rates], atol=0.03)
    assert weight[0] < 0.4 and weight[1] > 0.8
    assert ((post > 0.5) == (alone > 0.5)).mean() > 0.9
    odds = np.log(0.3 / 0.7) + sum(np.where(votes[:, j] > 0, np.log(a / b), np.log((1 - a) / (1 - b))) for j, (a, b) in enumerate(rates))
    assert ((post > 0.5) == (y == 1)).mean() > ((odds > 0) == (y == 1)).mean() - 0.01  # as good as with the true rates


def _votes(n: int, rates: list[tuple[float, float]], seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.3).astype(float)
    return y, np.stack([np.where(y == 1, r.random(n) < a, r.random(n) < b) for a, b in rates], axis=1).astype(float)


def test_wrong_labels_do_not_change_the_posteriors_of_clear_votes():
    y, votes = _votes(6000, [(0.7, 0.02), (0.6, 0.03), (0.5, 0.05), (0.5, 0.01), (0.4, 0.02)], 3)
    right, *_ = X.label_model(votes, y)
    wrong = np.where(np.random.default_rng(4).random(6000) < 0.25, 1 - y, y)
    other, *_ = X.label_model(votes, wrong)
    clear = (votes.sum(1) >= 3) | (votes.sum(1) == 0)
    assert clear.sum() > 3000 and np.abs(right - other)[clear].max() < 0.01
    assert ((other > 0.5) == (y == 1))[clear].mean() > 0.97
    assert np.allclose(X.label_model(votes, np.where(votes.sum(1) > 1, 1.0, 0.0))[0][clear], right[clear], atol=0.02)  # any fair start ends there


def test_accuracies_and_correlations_are_estimated():
    y, votes = _votes(8000, [(0.7, 0.02), (0.6, 0.03), (0.5, 0.05), (0.5, 0.01)], 5)
    r = np.random.default_rng(6)
    copy = np.where(r.random(8000) < 0.9, votes[:, 2], 0)  # fires with the third voter only
    votes = np.hstack([votes, copy[:, None]])
    parent = X.forest(votes, y)
    assert {(2, 4), (4, 2)} & {(i, j) for j, i in enumerate(parent) if i >= 0} and sum(i >= 0 for i in parent) == 1
    post, on, off, weight = X.label_model(votes, y)
    assert np.allclose(on[:4], [0.7, 0.6, 0.5, 0.5], atol=0.05) and np.allclose(off[:4], [0.02, 0.03, 0.05, 0.01], atol=0.03)
    assert weight[2] < 0.7 and weight[4] < 0.7 and weight[0] == weight[1] == 1
    # brute force: the posterior of each text from the joint rates of the pair and the rates of the others
    pair = votes[:, 2] * 2 + votes[:, 4]
    odds = np.full(8000, np.log(post.sum() / (1 - post).sum()))
    for w, sign in ((post, 1), (1 - post, -1)):
        for j in (0, 1, 3):
            p = (w @ votes[:, j]) / w.sum()
            odds += sign * np.where(votes[:, j] > 0, np.log(p), np.log(1 - p))
        joint = np.array([(w * (pair == k)).sum() / w.sum() for k in range(4)])
        odds += sign * np.log(np.maximum(joint, 1e-9))[pair.astype(int)]
    seen = pair != 1  # a state that hardly occurs is smoothed
    assert np.abs(1 / (1 + np.exp(-odds)) - post)[seen].max() < 0.02


def test_empty_tables_and_clashing_columns(spark, trained):
    docs = spark.createDataFrame([(i, "stone idiot" if i % 2 else "stone", "x", 0) for i in range(60)], "doc_id long, text string, toxic string, quality int")
    labels = spark.createDataFrame([(i, i % 2, "clash") for i in range(60)], "doc_id long, toxic int, text string")
    model = X.train(docs, labels)
    assert model.score(model.fired("idiot")) > model.score(model.fired("stone"))
    empty = X.train(docs.limit(0), labels)
    assert empty.score(empty.fired("idiot")) > X.TOXIC_FROM and X.score_toxicity(docs.limit(0), empty).count() == 0


def test_regression_separates():
    r = np.random.default_rng(2)
    x = (r.random((500, 4)) < 0.3).astype(float)
    w, b = X.regression(x, x[:, 0])
    assert w[0] > 4 and abs(w[1:]).max() < 1 and b < -2


WORDS = "house river morning people walked under never window table light garden stone letter music paper winter".split()


def corpus() -> tuple[list[tuple], list[tuple]]:
    r = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        w = r.choices(WORDS, k=r.randint(20, 80))
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(2):
                w[r.randrange(len(w))] = r.choice(["idiot", "Scum", "grobl" + r.choice("abcdefgh")])
        docs.append((i, " ".join(w)))
        if r.random() < 0.8:
            labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [*labels, (None, 1), (3, None), labels[0]]
    return docs, labels, d, X.train(d, spark.createDataFrame(rows, "doc_id long, toxic int"))


def test_held_out_texts(trained):
    docs, labels, _, model = trained
    text = dict(docs)
    rest = [(model.score(model.fired(text[i])), t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(rest) > 100 and all((s >= X.TOXIC_FROM) == bool(t) for s, t in rest)
    assert "grob*" in model.features and not any(w in model.features for w in WORDS)


def test_labels_that_are_held_out_are_never_read(spark, trained):
    docs, labels, d, model = trained
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    assert X.train(d, spark.createDataFrame(flipped, "doc_id long, toxic int")) == model


def test_rows(spark, trained):
    model = trained[3]
    data = [(1, None, 0.5), (1, None, 0.5), (None, "", 0.1), (2, "you are an IDIOT", 0.2), (3, "stone " * 100000 + "groblx", 0.3)]
    df = spark.createDataFrame(data, "doc_id long, text string, score double")
    got = [r["score"] for r in X.score_toxicity(df, model).collect()]
    assert got[0] == got[1] == got[2] < 0.2 and got[3] > X.TOXIC_FROM and got[4] > got[0]
    assert X.score_toxicity(df.limit(0), model).count() == 0


def test_without_labels_the_lexicons_score_alone(spark, trained):
    model = X.train(trained[2], spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.score(model.fired("what an idiot")) > X.TOXIC_FROM and model.score(model.fired("what a stone")) < 0.1
