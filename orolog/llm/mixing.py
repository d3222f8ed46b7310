"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree.

Every document of a source has the same expected number of copies, target / source size. Its whole part is
taken outright; the fraction left is a probability. Rows equal in id, text, source and size are one group: of
its n fractions the whole part is taken as well, so that a group of any size is one row and one fraction. Two
fractional groups exchange mass, measured in words, at random and without drift until one of them has
probability 0 or 1; so a source's expected words are kept exactly in every step. Leaves of about LEAF_ROWS groups
of one source do this in one streamed pass each and leave one fractional group at most. The residuals meet FAN_IN
leaves at a time, level by level, until each source has one at most. A hot source only has more leaves.

What is left at the root, less than one document, is not taken from it; the words that are missing then are made up
by spare copies (up to 3 of a document) of documents that fit into the gap, the largest first.

Draws are hashes of the rows that meet and the seed, and leaves are cut by hashes of the rows, so reruns agree
however the input is partitioned. Texts are told apart by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.llm._shared import WORD, columns, cut, map_rows, partitions, running_sums

LEAF_ROWS = 2048
FAN_IN = 64
MAX_COPIES = 3
CYCLE = (5, 2, 1)
NEAR = 1e-12
#: Sources, and characters of their names, up to which the table of sources is broadcast; beyond, it is joined in an exchange.
BROADCAST_SOURCES, BROADCAST_CHARS = 200_000, 16_000_000
#: Places that a source's rows are spread over in that exchange.
SALTS = 64
#: Rows of one group that a task expands at once.
EXPAND_ROWS = 4096
#: Documents of each power of two of words that are kept as candidates for spare copies of a source; four can fill the gap down to the next power.
SPARES = 8

#: What tells a group of equal rows from others, beside doc_id.
KEY = ("hash_a", "hash_b", "source_no", "size")
#: A group in the tree; `taken` is what its source's whole part and its own whole fractions give.
NODE = "hash_a long, hash_b long, source_no long, size long, rows long, tie long, node long, taken long"


def word_count(text: Column) -> Column:
    """Words of the text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_hashes(text: Column) -> list[Column]:
    """128 bits that stand for the text, as two longs; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("hash_a"), F.xxhash64(F.lit(17), whole).alias("hash_b")]


def targets(sizes: list[int], weights: list[int] | None = None, cap: int = MAX_COPIES) -> list[float]:
    """Shares of the sum of all sizes by weight, none above cap times its own size; the excess is shared again by weight.

    Sources are capped in order of size / weight, so that one pass over the sorted list finds the last.
    """
    weights = weights or [CYCLE[i % len(CYCLE)] for i in range(len(sizes))]
    left, weight, unit = sum(sizes), sum(weights), 0.0
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    for i in order:
        unit = left / weight
        if unit * weights[i] <= cap * sizes[i]:
            break
        left, weight = left - cap * sizes[i], weight - weights[i]
    return [float(min(cap * s, unit * w)) for s, w in zip(sizes, weights, strict=True)]


def source_table(words: DataFrame) -> DataFrame:
    """``source, source_size, groups, source_no, target`` from ``source, source_size, groups``, one row for each source.

    Sources are numbered by code point, null last, and capped in order of size / weight as in `targets`: both are
    running sums over a range exchange, so that the number of sources is not limited.
    """
    in_order = running_sums(words.withColumn("none", F.col("source").isNull()), ["none", "source"], {}, "source_no")
    weight = F.element_at(F.array(*map(F.lit, CYCLE)), (F.col("source_no") % len(CYCLE) + 1).cast("int"))
    weighed = in_order.withColumn("weight", weight.cast("long")).withColumn("fill", F.col("source_size") / F.col("weight"))
    sums = cut(running_sums(weighed, ["fill", "source_no"], {"words_before": "source_size", "weight_before": "weight"}, "place"), "mix-sources")
    total = sums.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words_left = F.lit(total["words"] or 0) - MAX_COPIES * F.col("words_before")
    weight_left = F.lit(total["weight"] or 0) - F.col("weight_before")
    unit = words_left / weight_left
    first = sums.where(unit * F.col("weight") <= MAX_COPIES * F.col("source_size")).orderBy("place").select(unit.alias("unit")).first()
    share = F.col("weight") * F.lit(float(first["unit"]) if first else 0.0)
    return sums.select("source", "source_size", "groups", "source_no", F.least(share, (MAX_COPIES * F.col("source_size")).cast("double")).alias("target"))


def _draw(seed: int, *ids: object) -> float:
    return int.from_bytes(hashlib.blake2b(repr((seed, ids)).encode(), digest_size=7).digest(), "big") / 2**56


def settle(p: float, a: int, q: float, b: int, draw: float) -> tuple[float, float]:
    """One pivotal step: p * a + q * b stays, the expectations of p and q stay, and one of them becomes 0 or 1."""
    up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
    if up + down <= 0:  # nothing can move
        return (1.0 if p > 1 - NEAR else p), (1.0 if q > 1 - NEAR else q)
    if draw * (up + down) < down:
        return (1.0, q - (1 - p) * a / b) if (1 - p) * a <= q * b else (p + q * b / a, 0.0)
    return (0.0, q + p * a / b) if p * a <= (1 - q) * b else (p - (1 - q) * b / a, 1.0)


def _whole(p: float) -> int | None:
    return 0 if p < NEAR else 1 if p > 1 - NEAR else None


def _pivot(seed: int) -> Callable[[], Callable[..., list[list]]]:
    """Streams rows ordered by node; a row comes out once it is settled or its node ends. `extra` is 0, 1 or null (still fractional)."""

    def make() -> Callable[..., list[list]]:
        held: list[tuple] = []  # the one fractional row of the node that is being read

        def step(*columns: list) -> list[list]:
            rows: list[tuple] = []
            for *row, p, last in zip(*columns, strict=True):
                size = row[4]
                if size <= 0 or _whole(p) is not None:
                    rows.append((*row, float(p), _whole(p) or 0))
                elif not held:
                    held.append((row, p))
                else:
                    other, q = held.pop()
                    q, p = settle(q, other[4], p, size, _draw(seed, *other[:3], *row[:3], row[7]))
                    for r, x in ((other, q), (row, p)):
                        if (w := _whole(x)) is not None:
                            rows.append((*r, x, w))
                        else:
                            held.append((r, x))
                if last and held:
                    r, x = held.pop()
                    rows.append((*r, x, None))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(len(columns))]

        return step

    return make


def _level(df: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: `df` has doc_id, NODE's columns and `p`; rows of a node are read in one order, largest first."""
    from pyspark.sql import Window

    order = [F.col("size").desc(), "tie", "doc_id", "hash_a", "hash_b"]
    names = [f.name for f in T.StructType.fromDDL(NODE).fields]
    ordered = df.withColumn("last", F.lead("node").over(Window.partitionBy("source_no", "node").orderBy(*order)).isNull())
    schema = T.StructType([df.schema["doc_id"], *T.StructType.fromDDL(NODE + ", p double, extra int").fields])
    return map_rows(ordered.select("doc_id", *names, "p", "last"), schema, _pivot(seed))


def fill(gap: float, spare: list[tuple[int, int]]) -> list[int]:
    """Copies taken of each (size, spare copies), largest size first, that leave least of the gap; at the end one that overshoots by less."""
    out = []
    for size, copies in spare:
        n = max(0, min(copies, int(gap // size)))
        out.append(n)
        gap -= n * size
    for i in reversed(range(len(spare))):  # the smallest that has a copy left
        size, copies = spare[i]
        if out[i] < copies:
            out[i] += 2 * gap > size
            break
    return out


def _spares(settled: DataFrame, sources: DataFrame) -> DataFrame:
    """``doc_id`` and KEY of the groups that spare copies are taken of, with ``more`` copies, so that each source comes near its target.

    Of each source and power of two of words SPARES groups are candidates, so a source's candidates are few.
    """
    gaps = settled.groupBy("source_no").agg(F.sum(F.col("taken") * F.col("size")).alias("words")).join(sources, "source_no").select("source_no", (F.col("target") - F.col("words")).alias("gap"))
    room = settled.withColumn("spare", MAX_COPIES * F.col("rows") - F.col("taken")).where("spare > 0 and size > 0")
    item = F.struct((-F.col("size")).alias("less"), "tie", "doc_id", "hash_a", "hash_b", "size", "spare")
    few = room.groupBy("source_no", F.floor(F.log2("size")).alias("power"), F.pmod("tie", F.lit(SPARES)).alias("k")).agg(F.max(item).alias("item"))
    listed = few.groupBy("source_no").agg(F.sort_array(F.collect_list("item")).alias("items")).join(gaps, "source_no")
    chosen = listed.select("source_no", "items", F.expr("transform(items, x -> x.size) sizes"), F.expr("transform(items, x -> x.spare) spares"), "gap")

    def make() -> Callable[..., list[list]]:
        return lambda n, sizes, spares, gap: [n, [fill(g, list(zip(s, c, strict=True))) for s, c, g in zip(sizes, spares, gap, strict=True)]]

    taken = map_rows(chosen.select("source_no", "sizes", "spares", "gap"), "source_no long, more array<long>", make)
    each = chosen.select("source_no", "items").join(taken, "source_no").select("source_no", F.explode(F.arrays_zip("items", "more")).alias("x")).where("x.more > 0")
    return each.select("x.items.doc_id", "x.items.hash_a", "x.items.hash_b", "source_no", "x.items.size", "x.more")


def _with_sources(rows: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Rows with the other columns of their source, found by name or number. As a rule names are few and are broadcast; else both sides are salted, so that a hot source is spread."""
    width = sources.agg(F.count("*").alias("n"), F.sum(F.length("source")).alias("chars")).first()
    named = sources.withColumnRenamed(key, "named_key")
    if width["n"] <= BROADCAST_SOURCES and (width["chars"] or 0) <= BROADCAST_CHARS:
        return rows.join(F.broadcast(named), rows[key].eqNullSafe(named["named_key"])).drop("named_key")
    named = named.withColumn("named_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "hash_a"), F.lit(SALTS)).cast("int"))
    return salted.join(named, salted[key].eqNullSafe(named["named_key"]) & (salted["salt"] == named["named_salt"])).drop("salt", "named_salt", "named_key")


def _mixed_groups(df: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, leaf_rows: int, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """Groups of equal rows with the copies that all of a group's rows are taken together, and the table of sources."""
    text = df[text_col]
    rows = df.select(df[id_col].alias("doc_id"), *text_hashes(text), df[source_col].cast("string").alias("source"), word_count(text).alias("size"))
    groups = rows.groupBy("doc_id", "hash_a", "hash_b", "source", "size").agg(F.count("*").alias("rows"))
    groups = cut(groups.withColumn("tie", F.xxhash64("doc_id", "hash_a", "hash_b", "size")), "mix-groups")
    words = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("groups"))
    sources = cut(source_table(words), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MAX_COPIES)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    placed = _with_sources(groups, sources, "source").withColumn("rate", rate)
    placed = placed.withColumn("sure", F.floor(F.col("rate"))).withColumn("share", (F.col("rate") - F.col("sure")) * F.col("rows"))
    placed = placed.withColumn("more", F.floor(F.col("share"))).withColumn("p", F.col("share") - F.col("more"))
    placed = placed.withColumn("leaves", F.ceil(F.col("groups") / leaf_rows)).withColumn("node", F.pmod("tie", "leaves"))
    placed = placed.withColumn("taken", (F.col("sure") * F.col("rows") + F.col("more")).cast("long"))
    most = sources.agg(F.max("groups").alias("n")).first()["n"] or 0
    level, settled, width = placed.select("doc_id", *(f.name for f in T.StructType.fromDDL(NODE).fields), "p"), [], -(-most // leaf_rows)
    while True:
        done = cut(_level(level, seed), "mix-level")
        if width <= 1:
            settled.append(done.withColumn("extra", F.coalesce("extra", F.lit(0))))
            break
        settled.append(done.where("extra is not null"))
        width = -(-width // fan_in)
        level = done.where("extra is null").withColumn("node", F.expr(f"node div {fan_in}")).select(*level.columns)
    out = reduce(DataFrame.unionByName, settled)
    out = cut(out.select("doc_id", *KEY, "rows", "tie", (F.col("taken") + F.col("extra")).alias("taken")), "mix-settled")
    spare = cut(_spares(out, sources), "mix-spares")
    s = spare.select(F.col("doc_id").alias("s_id"), *(F.col(k).alias(f"s_{k}") for k in KEY), "more")
    met = reduce(lambda a, b: a & b, (out[k] == s[f"s_{k}"] for k in KEY), out["doc_id"].eqNullSafe(s["s_id"]))
    filled = out.join(s, met, "left").select(*(out[c] for c in ("doc_id", *KEY, "rows")), (F.col("taken") + F.coalesce("more", F.lit(0))).alias("taken"))
    return filled, sources


def mix(df: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Number of copies of every row so that each source's words meet its target.

    Returns ``doc_id, source, size, source_size, target, copies``, one row for each row of ``df``. Ids may be of any
    type that can be ordered. Null texts and texts without a word have size 0 and are taken as the whole part says; a
    null source is a source of its own, last in order; rows equal in id, text and source share their group's copies
    evenly; an empty table gives no rows. No row has more than 3 copies. Only the named columns of ``df`` are read.
    """
    groups, sources = _mixed_groups(df, seed, id_col, text_col, source_col, leaf_rows, fan_in)
    few, many = groups.where(F.col("rows") <= EXPAND_ROWS).withColumn("part", F.lit(0).cast("long")), groups.where(F.col("rows") > EXPAND_ROWS)
    many = many.withColumn("part", F.explode(F.expr(f"sequence(0L, (rows - 1) div {EXPAND_ROWS})")))
    if not many.isEmpty():  # a large group is expanded in many places
        few = few.unionByName(many.repartition(partitions(df.sparkSession), "doc_id", "hash_a", "part"))
    first = F.col("part") * EXPAND_ROWS
    each = few.withColumn("place", F.explode(F.sequence(first, F.least(F.col("rows"), first + EXPAND_ROWS) - 1)))
    copies = F.expr("taken div rows") + (F.col("place") < F.expr("taken % rows")).cast("long")
    listed = each.select("doc_id", "hash_a", "source_no", "size", copies.alias("copies"))
    return _with_sources(listed, sources, "source_no").select("doc_id", "source", "size", "source_size", "target", "copies")


def mixed(df: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them; all columns as they are.

    Of rows that agree in id, text and source one stands for all: it comes as often as the mix takes them together.
    """
    groups, sources = _mixed_groups(df, seed, id_col, text_col, source_col, LEAF_ROWS, FAN_IN)
    taken = _with_sources(groups.where("taken > 0"), sources, "source_no")
    taken = cut(taken.select(F.col("doc_id").alias("t_id"), F.col("hash_a").alias("t_a"), F.col("hash_b").alias("t_b"), F.col("source").alias("t_source"), "taken", "rows"), "mix-taken")
    a, b = text_hashes(df[text_col])
    keyed = df.select(F.struct(*columns(df)).alias("row"), df[id_col].alias("__id"), a.alias("__a"), b.alias("__b"), df[source_col].cast("string").alias("__source"))

    def of(some: DataFrame, these: DataFrame) -> DataFrame:
        return these.join(some, these["__id"].eqNullSafe(some["t_id"]) & (these["__a"] == some["t_a"]) & (these["__b"] == some["t_b"]) & these["__source"].eqNullSafe(some["t_source"]))

    once = of(taken.where("rows = 1"), keyed).select("row", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int")))).select("row.*")
    several = taken.where("rows > 1")
    if several.isEmpty():
        return once
    # one row of each group, and its copies dealt out in parts
    key = ["__id", "__a", "__b", "__source"]
    one = of(several, keyed).groupBy(*key).agg(F.first("row").alias("row"), F.first("taken").alias("taken"))
    parts = one.withColumn("part", F.explode(F.expr(f"sequence(0L, (taken - 1) div {EXPAND_ROWS})")))
    dealt = parts.repartition(partitions(df.sparkSession), "__a", "part")
    more = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(EXPAND_ROWS).cast("long"), F.col("taken") - F.col("part") * EXPAND_ROWS))))
    return once.unionByName(more.select("row.*"))
