"""Viterbi against all labellings, and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
from itertools import product

import numpy as np
import pytest

from orolog.llm import langid as L

TEXTS = {
    "en": "the people of this house walked through the morning and they found that with every hour which was given there would be another thing to see",
    "de": "die leute dieses hauses gingen durch den morgen und fanden dass mit jeder stunde die ihnen gegeben wurde noch eine andere sache zu sehen war",
    "fr": "les gens de cette maison ont traversé le matin et ils ont trouvé que chaque heure qui leur était donnée montrait encore une autre chose à voir",
    "ru": "люди этого дома шли через утро и видели что каждый час который был дан показывал ещё одну вещь",
}


def made(lang: str, n: int, r: random.Random) -> str:
    return " ".join(r.choice(TEXTS[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(1)
    rows = [(i, lang, made(lang, r.randint(20, 60), r)) for i in range(240) for lang in [list(TEXTS)[i % 4]]] + [(999, None, "unknown"), (998, "en", None)]
    return L.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))


def test_viterbi_is_the_best_labelling():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        for scale in (0.5, 4, 12):
            s = r.normal(0, scale, (n, 3))
            cost = lambda path: s[range(n), path].sum() - 5.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))
            best = max(product(range(3), repeat=n), key=cost)
            spans = L.viterbi(s, 5.0)
            path = [k for a, b, k in spans for _ in range(b - a)]
            assert len(path) == n and cost(path) == pytest.approx(cost(best))


def test_viterbi_sees_two_gains_for_one_penalty():
    s = np.array([[0.0, -10.0, -30.0], [-30.0, -10.0, 0.0]])
    assert L.viterbi(s, 12.0) == [(0, 1, 0), (1, 2, 2)]
    r = np.random.default_rng(8)
    for _ in range(400):
        s = r.normal(0, 6, (4, 3)) + np.array([0.0, 3.0, 0.0])
        cost = lambda path: s[range(4), path].sum() - 12.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        got = [k for a, b, k in L.viterbi(s) for _ in range(b - a)]
        assert cost(got) == pytest.approx(max(map(cost, product(range(3), repeat=4))))


def test_held_out_texts(model):
    r, labeller = random.Random(9), L.Labeller(model)
    for lang in TEXTS:
        for _ in range(25):
            got, score, spans = labeller.label(made(lang, 12, r))
            assert got == lang and score > 0.9 and len(spans) == 1


def test_mixed_text_falls_into_spans(model):
    r, labeller = random.Random(4), L.Labeller(model)
    text = f"{made('en', 40, r)}. {made('de', 25, r)}! {made('ru', 30, r)}"
    spans = labeller.spans(text)
    assert [x[2] for x in spans] == ["en", "de", "ru"] and abs(spans[1][0] - text.index(".")) < 25
    assert labeller.label(text)[0] == "en" and 0.2 < labeller.label(text)[1] < 0.7


def test_scripts_narrow_the_candidates(model):
    assert L.script("a") == "Latin" and L.script("ж") == "Cyrillic" and L.script("漢") == "Han" and L.script("1") == ""
    scores = model.score("цифра")
    assert max(range(4), key=scores.__getitem__) == model.languages.index("ru")
    assert len(set(model.score("漢字"))) == 1


def test_rows(spark, model):
    data = [(1, None, "x"), (1, None, "x"), (None, "123 ½ ²!", "y"), (2, "", "z"), (3, made("fr", 30000, random.Random(2)), None), (4, "漢字漢字", "w")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang_pred string")
    got = [(r["lang_pred"], r["score"]) for r in L.identify(df, model).collect()]
    assert got[:4] == [("und", 0.0)] * 4 and got[4][0] == "fr" and got[5][1] <= 0.5
    assert L.identify(df.limit(0), model).count() == 0
    nothing = L.train(spark.createDataFrame([], "doc_id long, lang string, text string"))
    assert {r["lang_pred"] for r in L.identify(df, nothing).collect()} == {"und"}
    assert L.keep_identified(df, model, 0.6).count() == 1
    russian = L.Model(["ru"], {}, [{"Cyrillic": 1.0}])
    assert L.keep_identified(df, russian, 0.35).count() == 0


def test_only_candidates_are_scored(model):
    model.known.clear()
    kind, scores = model.scored("цифра")
    assert kind == "Cyrillic" and len(scores) == 1 == len(model.candidates("Cyrillic")) and set(model.known) == {"Cyrillic"}
    assert all(len(x) == 1 for x in model.known["Cyrillic"].values())
    assert len(model.scored("maison")[1]) == 3


def brute(model, text: str) -> tuple[str, float]:
    """Language and score by a plain programme over all languages and words."""
    found = re.findall(r"[^\W\d_]+", text.lower())
    n = len(model.languages)
    rows = [model.score(w) for w in found]
    best, back = list(rows[0]), []
    for row in rows[1:]:
        top = max(range(n), key=best.__getitem__)
        step = [k if best[k] >= best[top] - L.SWITCH else top for k in range(n)]
        best = [(best[k] if step[k] == k else best[top] - L.SWITCH) + row[k] for k in range(n)]
        back.append(step)
    k = max(range(n), key=best.__getitem__)
    path = [k]
    for step in reversed(back):
        path.append(k := step[k])
    path.reverse()
    share = [sum(len(w) for w, p in zip(found, path, strict=True) if p == k) for k in range(n)]
    k = max(range(n), key=share.__getitem__)
    own = [sum(r[j] for r, p in zip(rows, path, strict=True) if p == k) for j in range(n)]
    lead = own[k] - max(x for j, x in enumerate(own) if j != k)
    return model.languages[k], share[k] / sum(share) / (1 + math.exp(-max(-50, min(50, lead))))


def test_language_and_score_match_brute_force(model):
    r, labeller = random.Random(14), L.Labeller(model)
    for _ in range(150):
        text = " ".join(made(r.choice(list(TEXTS)), r.randint(1, 12), r) for _ in range(r.randint(1, 4)))
        got, want = labeller.label(text), brute(model, text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-6)


def test_any_number_of_languages_and_null_ids(spark):
    rows = [(None if i % 2 else i, f"l{i % 700:03}", f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 5 + str(i)) for i in range(1400)]
    labelled = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    many = L.train(labelled)
    assert len(many.languages) == 700 and L.Labeller(many).label("wordaa wordaa")[0] in many.languages
    one = labelled.selectExpr("cast(null as long) doc_id", "'x' lang", "text")
    languages, chosen = L.sample(one, 140)
    assert languages == ["x"] and 60 < chosen.count() < 260  # about a tenth of them, not all


def test_a_very_long_mixed_text(model):
    r, labeller = random.Random(15), L.Labeller(model)
    text = " ".join(made(lang, 40_000, r) for lang in ("de", "ru", "en"))
    lang, score, spans = labeller.label(text)
    assert [model.languages[k] for *_, k in spans] == ["de", "ru", "en"] and 0.2 < score < 0.6
