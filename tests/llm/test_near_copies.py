"""Near copies against brute force over all pairs."""

from __future__ import annotations

import random

import corpus_pipeline as C
from orolog.llm import near_copies as J


def brute_set(text: str | None) -> set:
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(a: set, b: set) -> bool:
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_kept(rows: list[tuple]) -> list[int]:
    sets, parent = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near(sets[i], sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted({rows[find(i)][0] for i in range(len(rows))})


def corpus() -> list[tuple]:
    """Texts with copies in which words are replaced, similarities from 0.5 to 1, and a large group around one text."""
    r, out = random.Random(6), []
    for n in (60, 120, 300, 800):
        for _ in range(15):
            base = [f"w{r.randrange(9000)}" for _ in range(n)]
            out.append(" ".join(base))
            for share in (0.01, 0.02, 0.03, 0.05, 0.08):
                w = list(base)
                for i in r.sample(range(n), max(1, round(share * n))):
                    w[i] = f"x{r.randrange(9000)}"
                out.append(" ".join(w))
    base = [f"g{r.randrange(9000)}" for _ in range(200)]
    for _ in range(150):
        w = list(base)
        for i in r.sample(range(200), r.randint(1, 8)):
            w[i] = f"y{r.randrange(9000)}"
        out.append(" ".join(w))
    out += [out[0].upper(), "", None, " \n", "one two", "One Two", "one two three"]
    return list(enumerate(out))


def test_stage_keeps_what_brute_force_keeps(spark):
    rows = corpus()
    got = [r["doc_id"] for r in C.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    assert sorted(got) == brute_kept(rows)


def test_the_limit_itself_is_near():
    import numpy as np

    a = np.arange(9, dtype="<u8")
    assert J.similar(a, a[:8]) and J.similar(a, np.append(a[:8], np.uint64(99))) and not J.similar(a, a[:7])


def test_pairs_of_a_large_group_below_the_limit_are_no_rows(spark, monkeypatch):
    """Texts around one base, most of them a little under the limit to each other: rows grow with the members, not with their pairs."""
    r = random.Random(8)
    base = [f"g{r.randrange(9000)}" for _ in range(1000)]
    rows = []
    for i in range(240):
        w = list(base)
        for k in r.sample(range(1000), 13):
            w[k] = f"y{r.randrange(9000)}"
        rows.append((i, " ".join(w)))
    made, cut = [], J.cut

    def counted(df, label):
        out = cut(df, label)
        made.append(out.count())
        return out

    monkeypatch.setattr(J, "cut", counted)
    got = [x["doc_id"] for x in C.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    sets = [brute_set(t) for _, t in rows]
    most = J.shape(240)[1] * 240
    assert sum(0.74 < len(a & b) / len(a | b) < 0.8 for k, a in enumerate(sets) for b in sets[:k]) > 1.2 * most
    assert sorted(got) == brute_kept(rows)
    assert max(made) <= most
