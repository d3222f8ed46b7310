"""The pipeline's stages, each on its own input against a brute-force version."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as C
from orolog.llm import decontaminate, mixing
from orolog.llm._shared import shared_root
from tests.llm.test_simhash import brute_components, brute_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus() -> list[tuple]:
    r = random.Random(4)
    vocabulary = {"en": "the and with house river people morning under never walked window".split(), "de": "der und mit haus fluss menschen morgen unter niemals fenster schön".split()}
    out = []
    for i in range(160):
        lang = r.choice(["en", "de"])
        text = " ".join(r.choice(vocabulary[lang]) + str(r.randrange(40)) * (r.random() < 0.2) for _ in range(r.choice([40, 120, 700])))
        out.append((i, text, lang, f"s{min(3, r.randrange(8))}", len(text)))
    out += [(1000 + i, t[1], *t[2:]) for i, t in enumerate(out[:20])]
    out += [(2000, None, None, "s0", None), (2001, "", "en", None, 0), (2002, "123 456 !", "en", "s1", 9), (2003, "the house " * 3, None, None, 30)]
    out += [out[3], out[3]]
    return out


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory) -> str:
    d = tmp_path_factory.mktemp("pipeline")
    rows = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{d}/documents.parquet")
    words = rows[5][1].split()
    spark.createDataFrame([(1, " ".join(words[4:20])), (2, None), (3, "no such thing here")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def test_every_stage_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]

    kept = [tuple(r) for r in C.language(spark, docs, sf).collect()]
    assert bag(rows) - bag(kept) == bag(r for r in rows if r[0] in (2000, 2001, 2002)) and not bag(kept) - bag(rows)

    got = [tuple(r) for r in C.near_duplicates(spark, docs, sf).collect()]
    comp = brute_components([brute_fingerprint(r[1]) for r in rows])
    groups = defaultdict(list)
    for r, c in zip(rows, comp, strict=True):
        groups[c].append(r)
    assert bag(got) == bag(min(g, key=lambda r: r[0]) for g in groups.values())

    clean = [tuple(r) for r in C.benchmark(spark, docs, sf).collect()]
    window = [" ".join(rows_words[i : i + 10]) for rows_words in [next(r[1] for r in rows if r[0] == 5).split()[4:20]] for i in range(7)]
    hit = lambda t: any(f" {w} " in f" {t} " for w in window)
    assert bag(clean) == bag(r for r in rows if not (r[1] and hit(r[1]))) and len(clean) < len(rows)

    mixed = bag(C.mix(spark, docs, sf).collect())
    assert mixed == bag(C.mix(spark, docs, sf).collect()) and set(mixed) <= set(rows)
    assert all(n <= 3 * bag(rows)[r] for r, n in mixed.items())

    placed = C.shards(spark, docs, sf).collect()
    assert bag(r[:5] for r in placed) == bag(rows) and placed[0].__fields__ == [*docs.columns, "shard_bytes", "shard", "slot"]
    for s in {r["shard"] for r in placed}:
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sum(r["shard"] == s for r in placed)))


def test_texts_in_scripts_of_no_language_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    foreign = ["漢字 漢字 文書 " * 20, "Η γλώσσα του κειμένου αυτού δεν είναι γνωστή", "ภาษา ไทย เป็น ภาษา", "漢字文書漢字文書漢字文書 " * 9 + "the house"]
    kept = ["der fluss und mit haus morgen the river house people morning under", "the house with people never walked under 漢字"]
    planted = spark.createDataFrame([(3000 + i, t, None, "s0", len(t)) for i, t in enumerate(foreign + kept)], COLUMNS)
    got = {r["doc_id"] for r in C.language(spark, docs.unionByName(planted), sf).where("doc_id >= 3000").collect()}
    assert got == {3004, 3005}


def test_run_and_stage_columns(spark, sf):
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == columns
    before = set(os.listdir(shared_root(spark)))
    got = C.run(spark, sf).collect()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(shared_root(spark))) - before}
    assert left == {"mix", "shard-sums"}  # the last stage's input and its own table
    assert got and all(decontaminate.words(r["text"]) for r in got)
    assert {zlib.crc32(r["text"].encode()) for r in got}


def test_stages_take_empty_tables_and_clashing_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, sf).count() == 0
    extra = docs.selectExpr("*", "1 as shard", "'x' as row", "2L as fp", "3 as copies", "4 as __id", "5 as node")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, extra.selectExpr("*", "1 as `a.b`"), sf).columns == [*extra.columns, "a.b"]
    placed = C.shards(spark, extra, sf)
    assert placed.columns == [*(c for c in extra.columns if c != "shard"), "shard_bytes", "shard", "slot"] and placed.where("shard > 15").isEmpty()


def test_targets_are_reshared_above_three_times_the_source():
    got = mixing.targets([10, 1000, 1000])
    assert got[0] == 30 and abs(sum(got) - 2010) < 1e-6 and abs(got[1] / got[2] - 2) < 1e-9
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def test_a_later_stage_lets_go_of_what_an_earlier_one_held(spark):
    """Python workers are reused, so what a stage's tasks share must not stay for the stages after it."""
    from orolog.llm import _shared, langid

    model = langid.Model(["en"], {"a": {0: 1}}, [{"latin": 1.0}])
    docs = spark.createDataFrame([(i, "a house") for i in range(40)], "doc_id long, text string").repartition(4)
    assert langid.identify(docs, model).count() == 40

    def held_now(batches):
        for b in batches:
            yield b.from_pydict({"n": [sum(len(x) for k, x in vars(m).items() if k in ("_made", "_held", "_built") and isinstance(x, dict)) for m in (_shared, langid)]})

    def later() -> int:
        return sum(r["n"] for r in docs.select("doc_id").mapInArrow(held_now, "n long").collect())

    for _ in range(2):
        _shared.map_rows(docs, "doc_id long", lambda: lambda ids, texts: [ids]).count()
    _shared.map_rows(docs.repartition(16), "doc_id long", lambda: lambda ids, texts: [ids]).collect()
    assert later() == 0
