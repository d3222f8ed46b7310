"""Near copies by SimHash: tries of wider budget propose pairs of texts, the exact similarity of word shingles decides.

Two texts are near copies if their sets of WIDTH-word shingles have a Jaccard similarity of LEAST_TENTHS tenths. At
that limit two 64-bit fingerprints of the sets differ in about a seventh of their bits, too many for one trie: so a text has
several independent fingerprints, and each gives several tries, every one with other bits as its first levels. These
levels have no error budget, the walk over the others has BUDGET, and what it finds has to lie within CHECK bits in the next
fingerprint as well, so that hardly any other pair comes through. Levels grow with the number of texts, which keeps subtries
small, and the number of tries with the levels, so that a pair at the limit is found with probability RECALL at any size.

Texts of one shingle set are one member from the start. Pairs are compared in two rounds. The first takes a spanning
forest of what each subtrie proposes, so that a large group of near copies costs its size and not its square. The second takes
all proposed pairs of members that the first has not put into one component, so that none is left out; there the bits of all
fingerprints together tell most pairs below the limit, before any set is looked at. These pairs are never rows: a first walk
tells which members are in any, and a second walk has their sets with them, compares and returns a forest of the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.llm import simhash
from orolog.llm._shared import cut, map_batches, map_rows, partitions
from orolog.llm.simhash import BITS

WIDTH = 5
#: Similarity from which two texts are near copies, in tenths.
LEAST_TENTHS = 8
#: Share of bits in which fingerprints of two sets at the limit agree: sets of similarity s have a cosine of 2s / (1 + s).
AGREE = 1 - acos(2 * LEAST_TENTHS / (10 + LEAST_TENTHS)) / pi
#: Differing bits allowed in a trie's fingerprint and in the next one.
BUDGET, CHECK = 12, 16
#: Probability with which a pair at the limit is proposed.
RECALL = 0.999
#: Share of the pairs in one subtrie at the limit that keep both budgets (0.96 and 0.99 by the binomial law).
WITHIN = 0.94
LEAST_LEVELS = 12
#: Fingerprints of a text at least, and the standard deviations by which the differing bits of all of them may lie beyond those
#: expected at the limit in the second round: 0.999 of the pairs at the limit stay, and most of those of lower similarity go.
LEAST_PRINTS, SPARE = 16, 3.0
SEED = 42
#: Members whose shingle sets a task holds while others are compared with them.
HELD_SETS = 64
#: Rows of subtries that a task walks at once.
WALK_ROWS = 1 << 15
#: Bytes of their shingle sets, where these come along.
WALK_BYTES = 1 << 24


def shape(n: int) -> tuple[int, int, int]:
    """Levels without budget, tries, and fingerprints for n texts."""
    levels = max(LEAST_LEVELS, ceil(log2(max(1, n) / simhash.SUBTRIE_ROWS)))
    tries = ceil(log(1 - RECALL) / log(1 - WITHIN * AGREE**levels))
    return levels, tries, max(LEAST_PRINTS, ceil(tries / (BITS // levels)))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A-Z lowered; of a text with fewer words, the hash of all; none for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= width:
        return np.array([digest(join(words), SEED)], dtype="<u8")
    return np.unique(np.fromiter((digest(join(r), SEED) for r in zip(*(words[i:] for i in range(width)), strict=False)), dtype="<u8", count=len(words) - width + 1))


#: A row of a member in a trie.
MET = ["bucket", "tile", "side", "key", "next", "fp", "n", "root"]

#: Of each byte, its bits as eight counters of eight bits.
_COUNTERS = np.array([sum((b >> k & 1) << 8 * k for k in range(8)) for b in range(256)], dtype="<u8")


def fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """n independent SimHash fingerprints of a set of hashes, from hashes mixed in n ways."""
    odd, add = (np.random.default_rng(SEED).integers(0, 2**64, (2, n), dtype=np.uint64)) | np.array([[1], [0]], dtype=np.uint64)
    ones = np.zeros((8 * n, 8), dtype=np.int64)
    for at in range(0, len(hashes), 255 * 8):
        x = hashes[at : at + 255 * 8, None] * odd + add
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        counted = np.add.reduceat(_COUNTERS[x.view(np.uint8)], np.arange(0, len(x), 255), axis=0)  # no counter passes 255
        ones += counted.view(np.uint8).reshape(len(counted), 8 * n, 8).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").reshape(n, 8).view("<u8").ravel()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes have a similarity of LEAST_TENTHS tenths."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 10 * both >= LEAST_TENTHS * (len(a) + len(b) - both)


def members(df: DataFrame, id_col: str, text_col: str, n_fingerprints: int) -> DataFrame:
    """``doc_id, text_hash, fp, n, prints`` of every row; fp is a hash of the shingle set, n its size, prints its fingerprints."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("text_hash long, fp long, n long, prints array<long>").fields])

    def make() -> Callable[..., list[list]]:
        import xxhash

        def step(ids: list, hashes: list, texts: list) -> list[list]:
            sets = [shingles(t) for t in texts]
            fps = [simhash.signed(xxhash.xxh64_intdigest(s.tobytes(), SEED)) for s in sets]
            return [ids, hashes, fps, [len(s) for s in sets], [fingerprints(s, n_fingerprints).view(np.int64).tolist() if len(s) else [] for s in sets]]

        return step

    return map_rows(df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text_col]).alias("text_hash"), df[text_col].alias("text")), schema, make)


def _spread(rows: DataFrame, levels: int, tries: int, n: int, more: list[str]) -> DataFrame:
    """``bucket, key, next, fp, n`` and `more` columns of every member in every trie; members of a bucket agree in the first levels."""
    per = BITS // levels
    one = lambda t: f"struct(({t}L << 32) | (shiftrightunsigned(prints[{t // per}], {levels * (t % per)}) & {(1 << levels) - 1}L) as bucket, prints[{t // per}] as key, prints[{(t // per + 1) % n}] as next)"
    each = rows.where("n > 0").select("fp", "n", *more, F.explode(F.expr(f"array({', '.join(map(one, range(tries)))})")).alias("x"))
    return each.select("x.bucket", "x.key", "x.next", "fp", "n", *more)


def _dealt(spread: DataFrame) -> DataFrame:
    """Rows by bucket and key, with tile and side: buckets of more than TILE_ROWS members are cut into tiles, whose pairs are dealt apart."""
    spark, others = spread.sparkSession, [c for c in spread.columns if c not in ("bucket", "key")]
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > simhash.TILE_ROWS)
    large = cut(sizes, "near-large")
    rows = spread.select("bucket", F.lit(0).cast("long").alias("tile"), F.lit(0).cast("long").alias("side"), "key", *others)
    if not large.isEmpty():
        large = F.broadcast(large) if large.count() <= simhash.BROADCAST_ROWS else large
        plain = spread.join(large, "bucket", "left_anti").select("bucket", F.lit(0).cast("long").alias("tile"), F.lit(0).cast("long").alias("side"), "key", *others)
        tiles = spread.join(large, "bucket").withColumn("k", F.ceil(F.col("members") / (simhash.TILE_ROWS / 2))).withColumn("own", F.pmod(F.xxhash64("fp"), "k"))
        met = tiles.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2).cast("long")
        rows = plain.unionByName(met.select("bucket", (1 + low * F.col("k") + high).alias("tile"), side.alias("side"), "key", *others))
    return rows.repartition(partitions(spark), "bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "key", "fp")


def _walk(levels: int, limit: int | None = None, exact: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (bucket, tile, side, key, next, fp, n) to a forest of proposed pairs (a, b, bucket, part) of each bucket.

    With a limit of bits rows have (root, prints) as well, pairs of one root are none, and the first eight columns of all rows that
    are in any proposed pair come out; with `exact` rows have (root, prints, hashes), and a forest of the links (a, b) comes out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walked(rows: np.ndarray, prints: np.ndarray | None, sets: list[np.ndarray]) -> pa.RecordBatch:
            keys, near, fp, n = rows[:, 3].view(np.uint64), rows[:, 4].view(np.uint64), rows[:, 5], rows[:, 6]
            new = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            cuts = [0, *new.tolist(), len(rows)]
            roots, last, met = [], None, np.zeros(len(rows), dtype=bool)
            for a, b in zip(cuts, cuts[1:], strict=False):
                group, side = tuple(rows[a, :2].tolist()), rows[a, 2]
                neg = a + int(np.count_nonzero(rows[a:b, 3] < 0))  # keys are ordered as signed numbers
                parts = [(x, y) for x, y in ((a, neg), (neg, b)) if x < y]
                if side == 0:
                    roots += [(x, y, x, y) for x, y in parts] + ([(*parts[0], *parts[1])] if len(parts) == 2 else [])
                elif side == 1:
                    last = (group, parts)
                elif last and last[0] == group:
                    roots += [(*p, *q) for p in last[1] for q in parts]

            def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                good = (10 * np.minimum(n[a], n[b]) >= LEAST_TENTHS * np.maximum(n[a], n[b])) & (np.bitwise_count(near[a] ^ near[b]) <= CHECK)
                if prints is not None:
                    at = np.flatnonzero(good)
                    for k in range(0, len(at), 1 << 14):
                        part = at[k : k + (1 << 14)]
                        apart = prints[a[part]] ^ prints[b[part]]
                        bits = np.bitwise_count(apart).astype(np.int64)
                        good[part] = bits.sum(axis=1) <= limit
                        near_in = (bits <= BUDGET) & (np.roll(bits, -1, axis=1) <= CHECK)
                        now = rows[a[part], 0] >> 32
                        for t in range(int(now.max(initial=0))):  # a pair is proposed by the first trie that finds it, and by no other
                            f, shift = t // (BITS // levels), np.uint64(levels * (t % (BITS // levels)))
                            there = near_in[:, f] & ((apart[:, f] >> shift) & np.uint64((1 << levels) - 1) == 0)
                            good[part] &= ~(there & (t < now))
                    if exact:
                        at = np.flatnonzero(good)
                        good[at] = [similar(sets[x], sets[y]) for x, y in zip(a[at].tolist(), b[at].tolist(), strict=True)]
                    else:
                        met[a[good]] = met[b[good]] = True
                        good[:] = False  # pairs are counted by their members, and not kept
                return good

            found = np.array(simhash.trie_join(np.ascontiguousarray(keys), roots, BUDGET, alike, None if limit is None else rows[:, 7], every=False), dtype=np.int64).reshape(-1, 2)
            if limit is not None and not exact:
                return pa.RecordBatch.from_arrays([pa.array(c) for c in rows[met].T], names=MET)
            a, b = fp[found[:, 0]], fp[found[:, 1]]
            if exact:
                return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            size = np.diff(np.concatenate([new, [len(rows)]]), prepend=0)  # of each group
            held = np.maximum(1, size[np.searchsorted(new, found[:, 0], side="right")] // HELD_SETS)
            low = np.where(a < b, a, b)
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(np.where(a < b, b, a)), pa.array(rows[found[:, 0], 0]), pa.array((low.view(np.uint64) % held.astype(np.uint64)).astype(np.int64))], names=["a", "b", "bucket", "part"])

        wide = 7 if limit is None else 8
        rows, prints, sets = np.zeros((0, wide), dtype=np.int64), None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([rows, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:wide]], axis=1)])
            if limit is not None:
                more = batch.column(8).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
                prints = more if prints is None else np.concatenate([prints, more])
            if exact:
                sets += [np.frombuffer(x.as_buffer(), dtype="<u8").copy() for x in batch.column(9)]
            if len(rows) >= WALK_ROWS or sum(x.nbytes for x in sets) >= WALK_BYTES:
                group = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
                done = int(np.flatnonzero(group)[-1]) + 1 if group.any() else 0
                if done:
                    yield walked(rows[:done], None if prints is None else prints[:done], sets[:done])
                    rows, prints, sets = rows[done:], None if prints is None else prints[done:], sets[done:]
        if len(rows):
            yield walked(rows, prints, sets)

    return run


def _proposed(spread: DataFrame, levels: int) -> DataFrame:
    """Distinct pairs ``a, b`` of the forests with the place where they are compared, the first bucket that proposes them."""
    columns = ["bucket", "tile", "side", "key", "next", "fp", "n"]
    pairs = map_batches(_dealt(spread).select(*columns), _walk(levels), "a long, b long, bucket long, part long")
    return cut(pairs.groupBy("a", "b").agg(F.min(F.struct("bucket", "part")).alias("at")).select("a", "b", "at.bucket", "at.part"), "near-pairs")


def _met(spread: DataFrame, limit: int, levels: int) -> DataFrame:
    """MET of the rows that are in any proposed pair of different roots: at most one row for each member, trie and tile."""
    return map_batches(_dealt(spread).select(*MET, "prints"), _walk(levels, limit), ", ".join(f"{c} long" for c in MET))


def _linked(met: DataFrame, rooted: DataFrame, sets: DataFrame, limit: int, levels: int) -> DataFrame:
    """Links ``(a, b)`` of similar sets that join all proposed pairs of rows of `_met`; compared where the rows meet."""
    known = rooted.select("fp", "prints").join(sets, "fp")
    dealt = met.join(known, "fp").repartition(partitions(met.sparkSession), "bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "key", "fp")
    return map_batches(dealt.select(*MET, "prints", "hashes"), _walk(levels, limit, exact=True), "a long, b long")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar.

    Of one place up to about HELD_SETS first members are held, and every other member comes by once with the list of those
    that it is compared with: a set is sent to a place once, however many of the place's pairs it is in.
    """
    place = ["bucket", "part"]
    first = pairs.select(*place, "a").distinct().join(sets, F.col("a") == sets["fp"]).select(*place, F.lit(0).alias("kind"), F.col("a").alias("fp"), "hashes", F.expr("cast(array() as array<long>)").alias("others"))
    rest = pairs.groupBy(*place, "b").agg(F.collect_list("a").alias("others")).join(sets, F.col("b") == sets["fp"]).select(*place, F.lit(1).alias("kind"), F.col("b").alias("fp"), "hashes", "others")
    dealt = first.unionByName(rest).repartition(partitions(pairs.sparkSession), *place).sortWithinPartitions(*place, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            a, b = [], []
            for bucket, part, kind, fp, data, others in zip(*(c.to_pylist() if k != 4 else list(c) for k, c in enumerate(batch.columns)), strict=True):
                if now != (bucket, part):
                    now, held = (bucket, part), {}
                mine = np.frombuffer(data.as_buffer(), dtype="<u8")
                if kind == 0:
                    held[fp] = mine.copy()
                    continue
                good = [x for x in others if similar(held[x], mine)]
                a += good
                b += [fp] * len(good)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_batches(dealt, run, "a long, b long")


def _sets(df: DataFrame, distinct: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``fp, hashes`` of the members of pairs, worked out again from the text of their first row: sets take as much room as texts."""
    named = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    wanted = cut(distinct.join(named, "fp", "left_semi").select("fp", F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash")), "near-wanted")
    if wanted.count() <= simhash.BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    texts = texts.join(wanted, texts["id"].eqNullSafe(wanted["__id"]) & F.xxhash64(texts["text"]).eqNullSafe(wanted["__hash"])).select("fp", "text")

    def make() -> Callable[..., list[list]]:
        return lambda fps, listed: [fps, [shingles(t).tobytes() for t in listed]]

    return cut(map_rows(texts, "fp long, hashes binary", make).groupBy("fp").agg(F.first("hashes").alias("hashes")), "near-sets")


def links(df: DataFrame, distinct: DataFrame, size: tuple[int, int, int], id_col: str, text_col: str) -> DataFrame:
    """Links ``(a, b)`` between members ``fp, first, n, prints`` of ``df`` that join all proposed pairs of similar sets."""
    levels, tries, n = size
    bits = n * BITS
    limit = round(bits * (1 - AGREE) + SPARE * sqrt(bits * AGREE * (1 - AGREE)))
    forest = _proposed(_spread(distinct, levels, tries, n, []), levels)
    sets = _sets(df, distinct, forest, id_col, text_col)
    first = cut(_alike(forest, sets), "near-links")
    roots = cut(simhash.components(first), "near-roots")
    had = sets.select("fp")  # whoever has a proposed partner has one in the forest
    rooted = distinct.join(had, "fp", "left_semi").join(roots, distinct["fp"] == roots["node"], "left").select("fp", "n", "prints", F.coalesce("root", "fp").alias("root"))
    met = cut(_met(_spread(rooted, levels, tries, n, ["root", "prints"]), limit, levels), "near-met")
    return cut(first.unionByName(_linked(met, rooted, sets, limit, levels)), "near-links-all")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stand for their component of near copies, chosen and returned as by simhash.keep_one.

    Null and empty texts and texts without words are copies of each other; texts of fewer than WIDTH words are near
    copies only if all their words agree; an empty table gives no rows; other columns may have any names.
    """
    size = shape(df.count())
    every = cut(members(df, id_col, text_col, size[2]), "near-members")
    # equal fp, equal set: whichever row's set is taken
    one = cut(every.groupBy("fp").agg(F.min(simhash.order()).alias("first"), F.count("*").alias("rows"), *(F.first(c).alias(c) for c in ("n", "prints"))), "near-distinct")
    roots = simhash.components(links(df, one, size, id_col, text_col))
    return simhash.kept(df, simhash.placed(every.select("doc_id", "text_hash", "fp"), one.select("fp", "first", "rows"), roots), id_col, text_col)
