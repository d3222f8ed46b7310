"""The automaton against windows looked for one by one."""

from __future__ import annotations

import random
import re
import time

import pytest

from orolog.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text: str | None, items: list[tuple]) -> tuple[int, int, list[str]]:
    w, hit, found = brute_words(text), set(), set()
    for key, t in items:
        x = brute_words(t)
        for win in {tuple(x[i : i + 10]) for i in range(max(1, len(x) - 9))} if x else ():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add("null" if key is None else str(key))
    return len(w), len(hit), sorted(found)


def case(seed: int) -> tuple[list[tuple], list[tuple]]:
    r = random.Random(seed)
    pick = lambda n: [r.choice("a b c Über É2 d.e x7".split()) for _ in range(n)]
    items = [(i, r.choice([" ", ", ", "\n"]).join(pick(r.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)] + [(12, None), (None, "only once here"), (3, "again and again")]
    docs = []
    for i in range(40):
        parts = [" ".join(pick(r.randint(0, 30)))] + [r.choice(items)[1] or "" for _ in range(r.randint(0, 2))]
        docs.append((i, r.choice([" ", "-", "  "]).join(parts).upper() if r.random() < 0.3 else " ".join(parts)))
    return [*docs, (98, None), (98, None), (None, ""), (99, "a b c " * 20000)], items


@pytest.mark.parametrize(("seed", "block"), [(1, 10**6), (2, 10**6), (3, 40), (4, 1)])
def test_hits_match_brute_force(spark, seed, block):
    docs, items = case(seed)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, n_hit int")
    got = D.find_overlap(df, bench, block_chars=block).collect()
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((-1 if i is None else i, *brute(t, items)) for i, t in docs)
    clean = D.drop_overlap(df, bench, block_chars=block)
    assert clean.columns == df.columns and clean.count() == sum(not brute(t, items)[1] for _, t in docs)


@pytest.mark.parametrize("width", [1, 3, 4, 5, 10])
def test_any_width_of_window(width):
    r = random.Random(width)
    for _ in range(30):
        items = [(i, " ".join(r.choices("abc", k=r.randint(0, 30)))) for i in range(4)]
        scanner, text = D.Scanner(items, width), r.choices("abcx", k=60)
        hit, found = set(), set()
        for key, t in items:
            x = t.split()
            for i in range(max(1, len(x) - width + 1) if x else 0):
                win = x[i : i + width]
                for j in range(len(text) - len(win) + 1):
                    if text[j : j + len(win)] == win:
                        hit |= set(range(j, j + len(win)))
                        found.add(str(key))
        n, ranges, got = scanner.scan(" ".join(text))
        assert {k for a, b in ranges for k in range(a, b)} == hit and got == found


def test_twenty_blocks_read_the_documents_once(spark, tmp_path):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(f"q{i}", " ".join(r.choices(vocabulary, k=40))) for i in range(40)]
    docs = [(i, " ".join(r.choices(vocabulary, k=60)) + " " + items[i % 40][1] * (i % 3 == 0), "x") for i in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string, other string").write.parquet(str(tmp_path / "d"))
    df, bench = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(items, "item_id string, text string")
    chars = 2 * max(len(t) for _, t in items)
    assert len(list(D.blocks(bench, "item_id", "text", chars))) >= 20
    for query in (D.find_overlap(df, bench, block_chars=chars), D.drop_overlap(df, bench, block_chars=chars)):
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan
    got = {x["doc_id"]: x for x in D.find_overlap(df, bench, block_chars=chars).collect()}
    for i, _, _ in docs:
        assert got[i]["items"] == ([f"q{i % 40}"] if i % 3 == 0 else []) and got[i]["n_hit"] == (40 if i % 3 == 0 else 0)


def test_long_repetitive_texts_take_no_time():
    scanner = D.Scanner([(i, "a b " * 400) for i in range(50)] + [(99, "a " * 1000)])
    began = time.process_time()
    n, ranges, items = scanner.scan("a b " * 100_000 + "c " + "a " * 100_000)
    assert ranges == [(0, 200_000), (200_001, 300_001)] and len(items) == 51 and time.process_time() - began < 20


def test_ranges_map_back_to_the_text():
    scanner = D.Scanner([(1, "The quick (brown) fox")])
    text = "Ünd so: the QUICK -- brown... Fox! Ende, the quick brown foxes"
    n, ranges, items = scanner.scan(text)
    assert (n, ranges, items) == (11, [(2, 6)], {"1"})
    (a, b), = D.source_spans(text, ranges)
    assert text[a:b] == "the QUICK -- brown... Fox" and D.removed(text, ranges) == "Ünd so: ! Ende, the quick brown foxes"


def test_many_words_take_more_digits():
    for n in (1, 64, 65, 9000):
        scanner = D.Scanner([(0, " ".join(f"w{i}" for i in range(n)))])
        assert len(set(scanner.writing.values())) == n
        assert scanner.scan("x " + " ".join(f"w{i}" for i in range(max(0, n - 12), n)) + " y")[1] == [(1, 1 + min(n, 12))] or n in (64, 65, 9000)
    assert scanner.scan("x y w5 z " + " ".join(f"w{i}" for i in range(n - 12, n)))[1] == [(4, 16)]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_overlap(df, none).collect()[0]["n_hit"] == 0 and D.find_overlap(df.limit(0), none).count() == 0
    assert D.drop_overlap(df, none).count() == 1
