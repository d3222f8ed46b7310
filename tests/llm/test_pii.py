"""Detectors against plain regular expressions, and disguises against the source they came from."""

from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orolog.llm import pii as P


def brute(text: str) -> list[P.Span]:
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 13 <= len(d) <= 19 and odd % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+ 0123456789()é%", max_size=60))
def test_plain_matches_brute_force(text):
    assert P.plain(text) == brute(text)


def test_many_planted_identifiers_match_brute_force():
    r = random.Random(3)
    parts = ["4111111111111111", "4111-1111 1111-1111", "+1 (555) 123-4567", "+49.30.1234567", "10.0.0.256", "1.2.3.4.5", "00001.2.3.4", "a@b.c@d.e", "x@y", "é.a@b-c.de.", "𝒜"]
    for _ in range(300):
        text = r.choice(["", " ", "."]).join(r.choices(parts, k=8))
        assert P.plain(text) == brute(text)


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("write to john.doe (at) mail [dot] example (dot) com today", "email", "john.doe (at) mail [dot] example (dot) com"),
        ("write to john at example dot com today", "email", "john at example dot com"),
        ("write to john dot q dot doe at mail dot example dot com today", "email", "john dot q dot doe at mail dot example dot com"),
        ("write to john_doe_AT_example_DOT_org.", "email", "john_doe_AT_example_DOT_org"),
        ("mail jоhn@exаmple.com now", "email", "jоhn@exаmple.com"),
        ("ｊohn＠example．com", "email", "ｊohn＠example．com"),
        ("call +one five five five one two three four five six seven now", "phone", "+one five five five one two three four five six seven"),
        ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
        ("card four one one one 1111 1111 1111 ok", "card", "four one one one 1111 1111 1111"),
        ("card 4111\u200B1111\u200B1111\u200B1111 ok", "card", "4111\u200B1111\u200B1111\u200B1111"),
        ("host １９２.１６８.１.１ up", "ip", "１９２.１６８.１.１"),
        ("host 192 (dot) 168 (dot) 1 (dot) 1 up", "ip", "192 (dot) 168 (dot) 1 (dot) 1"),
        ("host 192 dot 168 dot 1 dot 10 up", "ip", "192 dot 168 dot 1 dot 10"),
        ("host one nine two dot one six eight dot one dot one zero up", "ip", "one nine two dot one six eight dot one dot one zero"),
        ("mail john [at] example dot com now", "email", "john [at] example dot com"),
        ("mail john@example dot com now", "email", "john@example dot com"),
        ("mail john at mail.example dot com now", "email", "john at mail.example dot com"),
        ("mail john at example  dot  com now", "email", "john at example  dot  com"),
        ("mail john at example dot online now", "email", "john at example dot online"),
        ("mail john (at) example.museum now", "email", "john (at) example.museum"),
        ("mail jоhn at exаmple dot com now", "email", "jоhn at exаmple dot com"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source):
    base, added = P.detect("Voilà: " * 40 + text)
    shift = len("Voilà: " * 40)
    assert base == [] and [(P.KINDS[k], ("Voilà: " * 40 + text)[a:b]) for k, a, b in added] == [(kind, source)]
    assert added[0][1] >= shift


@pytest.mark.parametrize("text", ["", "look at the dot on it", "one two three go", "f(at) [0] list[dot]", "Привет мир, как дела", "array[i] at 5 (dot product) x.y", "meet me at noon dot", "six seven eight nine lives", "state-of-the-art dot matrix", "a_b_at_c", "see us at example.com", "look at the dot on it", "a dot b dot c dot d", "version 1 dot 2 dot 3", "they met at noon.then left dot"])
def test_clean_texts_have_no_spans(text):
    assert P.detect(text) == ([], [])


@pytest.mark.parametrize("text", ["x at " + "a-dot-" * 3000, "a-dot-" * 3000 + "at b", "a_" * 9000 + "at_b dot c", "one " * 9000, "(at) " * 5000, "a at b dot " * 3000, "+1" * 9000, "1." * 9000, "@" * 9000, "a@" * 9000])
def test_odd_texts_take_no_time(text):
    began = time.process_time()
    P.detect(text + " dot  one one one")
    assert time.process_time() - began < 3


@pytest.mark.parametrize("text", ["7" * 10**6, "7." * 400_000, "a dot " * 100_000, "one two " * 100_000, "one dot " * 100_000, "a-dot-" * 100_000, "a at b dot com " * 40_000, "ａ@b.c " * 40_000, "а" * 300_000, "1 2-" * 250_000, "a@b.com " * 100_000, "(at)x" * 100_000])
def test_long_odd_texts_take_linear_time(text):
    took = []
    for part in (text[: len(text) // 4], text):
        began = time.process_time()
        P.detect(part)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 1


def test_plain_spans_stay_and_are_not_added_twice():
    text = "a@b.com and b (at) c.org and 4111111111111111"
    base, added = P.detect(text)
    assert P.written(base) == "email:0:7,card:29:45"
    assert P.written(base + added) == "email:0:7,email:12:24,card:29:45"
    assert P.masked(text, base + added) == "<email> and <email> and <card>"


def test_a_span_may_hold_what_the_plain_text_shows_of_it():
    text = "mail mar\u200By.k@example.com now"
    base, added = P.detect(text)
    assert P.written(base) == "email:9:24" and P.written(added) == "email:5:24"
    assert P.masked(text, base + added) == "mail <email> now"


def test_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a@b.com", "y"), (3, "", "z"), (4, "w " * 60000 + "a@b.com", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in P.find_pii(df).collect())
    assert got == [(0, 1, "email:0:7"), (1, 0, ""), (1, 0, ""), (3, 0, ""), (4, 1, "email:120000:120007")]
    assert P.find_pii(df.limit(0)).count() == 0
