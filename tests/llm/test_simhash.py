"""Fingerprints, the trie walk and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from orolog.llm import simhash as S


def brute_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(keys: list[int], budget: int = 4) -> list[int]:
    parent = list(range(len(keys)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if (keys[i] ^ keys[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(keys))]


def near_keys(r: random.Random, n: int, groups: int, flips: int) -> list[int]:
    centres = [r.getrandbits(64) for _ in range(groups)]
    keys = {0, 2**64 - 1, 2**63, 1}
    while len(keys) < n:
        k = r.choice(centres)
        for _ in range(r.randint(0, flips)):
            k ^= 1 << r.randrange(64)
        keys.add(k)
    return list(keys)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "a b c d", "A b c D e É É ñ" * 3, "x y z " * 9000, "w\x0bv\x0cu\xa0t"])
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize(("n", "groups", "flips"), [(1, 1, 0), (60, 3, 6), (400, 4, 12), (700, 60, 5), (500, 1, 3)])
def test_trie_join_spans_what_brute_force_links(n, groups, flips):
    keys = sorted(near_keys(random.Random(n), n, groups, flips))
    edges = S.trie_join(np.array(keys, dtype=np.uint64), [(0, len(keys), 0, len(keys))])
    assert all(0 < (keys[a] ^ keys[b]).bit_count() <= 4 for a, b in edges)
    parent = list(range(len(keys)))
    for a, b in edges:
        x, y = parent[a], parent[b]
        assert x != y  # a forest
        parent = [min(x, y) if p in (x, y) else p for p in parent]
    assert parent == brute_components(keys)


@pytest.mark.parametrize(("fixed", "tile"), [(1, 10**6), (2, 10**6), (3, 10**6), (1, 64)])
def test_distributed_links_and_components(spark, fixed, tile):
    keys = near_keys(random.Random(5), 900, 12, 9)
    df = spark.createDataFrame([(S.signed(k),) for k in keys], "fp long")
    roots = {r["node"]: r["root"] for r in S.components(S.links(df, fixed=fixed, tile_rows=tile)).collect()}
    want = brute_components(keys)
    groups: dict[int, set[int]] = {}
    for k, c in zip(keys, want, strict=True):
        groups.setdefault(c, set()).add(S.signed(k))
    for g in groups.values():
        assert {roots.get(k, k) for k in g} == {min(g)}


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert {(r["node"], r["root"]) for r in S.components(df).collect()} == {(i, 0) for i in range(n)}


def test_blocks_cover_every_pair():
    r = random.Random(2)
    for k in (1, 2, 3):
        chosen = S.masks(k)
        for _ in range(300):
            x = sum(1 << b for b in r.sample(range(64), 4))
            assert any(x & m == 0 for m in chosen)
    assert [S.blocks_fixed(n) for n in (10, 10**7, 10**8, 10**11)] == [1, 1, 2, 3]


def rows() -> list[tuple]:
    r = random.Random(8)
    base = [" ".join(f"w{r.randrange(5000)}" for _ in range(r.choice([300, 2000]))) for _ in range(12)]
    out = [(i, t, "x") for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        w[len(w) // 2] = "changed"
        out += [(100 + i, " ".join(w), "near"), (200 + i, t.upper(), "copy")]
    return out + [(300, None, None), (301, "", ""), (302, " \n", ""), (300, None, None), (None, base[0], "no id"), (None, "alone in the world today", "no id")]


def test_near_duplicates_match_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, component_id string")
    got = S.near_duplicates(df).collect()
    assert len(got) == len(data)
    fps = [brute_fingerprint(t) for _, t, _ in data]
    comp = brute_components(fps)
    want = sorted((-1 if i is None else i, S.signed(f), min((j for (j, _, _), d in zip(data, comp, strict=True) if d == c and j is not None), default=-1)) for (i, _, _), f, c in zip(data, fps, comp, strict=True))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fp"], -1 if r["component_id"] is None else r["component_id"]) for r in got) == want
    kept = S.keep_one(df).collect()
    assert len(kept) == len(set(comp)) and kept[0].asDict().keys() == {"doc_id", "text", "component_id"}
    assert S.near_duplicates(df.limit(0)).count() == 0 and S.keep_one(df.limit(0)).count() == 0


def test_hot_keys_join_by_broadcast(spark, monkeypatch):
    r = random.Random(31)
    words = [f"w{r.randrange(500)}" for _ in range(60)]
    rows = [(i, " ".join(words)) for i in range(80)] + [(200 + i, "") for i in range(50)] + [(300 + i, " ".join([*words[:-1], f"x{i}"])) for i in range(20)]
    df = spark.createDataFrame([(*x, 0, "c") for x in rows], "doc_id long, text string, fp int, first string")
    want = sorted((x["doc_id"], x["component_id"]) for x in S.near_duplicates(df).collect())
    monkeypatch.setattr(S, "HOT_ROWS", 3)
    assert sorted((x["doc_id"], x["component_id"]) for x in S.near_duplicates(df).collect()) == want
    assert len(want) == 150 and dict(want)[79] == 0 and dict(want)[249] == 200
