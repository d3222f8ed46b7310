"""SimHash near-duplicates: fingerprints, a binary trie self-join of distinct fingerprints, and components.

Trie self-join. A sorted array of fingerprints is a binary trie: a node is the stretch of the array that shares
a prefix. Pairs of nodes are walked down together, bit by bit; a pair whose prefixes differ in more bits than
the budget is dropped with everything below it, a pair all of whose members must link is joined at once, and
pairs of small nodes are compared outright. All pairs of one depth are walked in array operations.

Distribution. Of BUDGET + k blocks of bits, two linked fingerprints agree in k blocks at least, whichever these
are. So every choice of k blocks is a trie whose first levels have a budget of zero: fingerprints are sent to
the task of their bits in those blocks, and the walk over the other bits there has the whole budget. k grows
with the number of distinct fingerprints, so that subtries stay small. Of a subtrie of more than TILE_ROWS members
(many fingerprints close to each other) the other bits are cut into BUDGET + 1 blocks in the same way; what is
still too large is cut into tiles, and every pair of tiles is walked in a task of its own. Each task hands on a spanning forest of the links that it finds, never all pairs.

Components of the links are found by alternating large-star and small-star steps over the forest's edges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.llm._shared import columns, cut, map_rows, partitions

BITS = 64
BUDGET = 4
SHINGLE = 4
SEED = 42
#: Mean members of a subtrie that the number of fixed blocks aims at.
SUBTRIE_ROWS = 4096
#: Members of a tile; larger subtries are cut.
TILE_ROWS = 16384
#: Products of node sizes up to which a pair of nodes is compared outright.
SMALL_PAIR = 64
#: Node pairs, or fingerprint pairs, that are walked in one array operation.
STEP_PAIRS = 1 << 17
#: Rows of subtries that a task walks at once.
WALK_ROWS = 1 << 16
#: Rows (id, text hash) up to which the documents that go are broadcast, so that texts stay where they are.
BROADCAST_ROWS = 2_000_000
#: Rows of one key beyond which its join is done by broadcast.
HOT_ROWS = 100_000


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z lowered; 0 for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 8192):
        part = words[at : at + 8192 + width - 1] if n > 1 else words
        runs = zip(*(part[i:] for i in range(width)), strict=False) if n > 1 else [part]
        h = np.array([digest(join(r), SEED) for r in runs], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; fp is the fingerprint as a signed long, text_hash tells texts apart."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("text_hash long, fp long").fields])

    def make() -> Callable[..., list[list]]:
        return lambda ids, hashes, texts: [ids, hashes, [signed(fingerprint(t)) for t in texts]]

    return map_rows(df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text_col]).alias("text_hash"), df[text_col].alias("text")), schema, make)


#: Which of the pairs of positions (a, b) link.
Alike = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Forest:
    """Union-find over array positions; `link` keeps only links that join two trees."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n, dtype=np.int64)
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = int(p[i])
        return i

    def join(self, label: np.ndarray) -> None:
        """Positions of one label become one tree."""
        _, first, at = np.unique(label, return_index=True, return_inverse=True)
        self.parent = first[at].astype(np.int64)

    def flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.flatten()
        apart = self.parent[a] != self.parent[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.edges.append((i, j))


def trie_join(keys: np.ndarray, roots: list[tuple[int, int, int, int]], budget: int = BUDGET, alike: Alike | None = None, label: np.ndarray | None = None, every: bool = True) -> list[tuple[int, int]]:
    """A spanning forest of the links between positions of `keys`, found by walking the given pairs of nodes.

    `keys` are unsigned; each root (a, a_end, b, b_end) is a pair of sorted stretches, either the same or disjoint.
    `alike` says which pairs of positions within the budget link besides; where it is missing all do. With `label`,
    positions of one label count as linked, and every link between different labels is returned, or without `every` a
    forest of them.
    """
    forest = Forest(len(keys))
    if label is not None:
        forest.join(label)
    zeros = {}  # by depth: number of keys before each position whose bit is 0

    def before(depth: int) -> np.ndarray:
        if depth not in zeros:
            zeros[depth] = np.concatenate([[0], np.cumsum((keys >> np.uint64(BITS - 1 - depth)) & np.uint64(1) == 0)])
        return zeros[depth]

    def compare(pairs: np.ndarray) -> None:
        """All members of small pairs of nodes against each other."""
        na, nb = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        each = na * nb
        for s in _slices(each):
            n, p = each[s], pairs[s]
            at = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            a, b = p[at, 0] + k // nb[s][at], p[at, 2] + k % nb[s][at]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            near &= a != b
            a, b = a[near], b[near]
            if label is not None:
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
            if alike is not None:
                good = alike(a, b)
                a, b = a[good], b[good]
            if label is not None and every:
                forest.edges += zip(a.tolist(), b.tolist(), strict=True)
            else:
                forest.link(a, b)

    stack = [(0, np.array(roots, dtype=np.int64).reshape(-1, 4), np.zeros(len(roots), dtype=np.int64))]
    while stack:
        depth, pairs, diff = stack.pop()
        if len(pairs) > STEP_PAIRS:
            half = len(pairs) // 2
            stack += [(depth, pairs[half:], diff[half:]), (depth, pairs[:half], diff[:half])]
            continue
        small = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= SMALL_PAIR
        compare(pairs[small])
        pairs, diff = pairs[~small], diff[~small]
        if len(pairs) and depth == BITS:  # equal keys, many of them
            compare(pairs)
        if len(pairs) and alike is None and label is None and depth >= BITS - budget:
            sure = diff + (BITS - depth) <= budget  # whatever the bits below, the members link
            for a, a_end, b, b_end in pairs[sure].tolist():
                every = np.concatenate([np.arange(a, a_end), np.arange(b, b_end)])
                forest.link(np.full(len(every), a), every)
            pairs, diff = pairs[~sure], diff[~sure]
        if len(pairs) and (label is not None or len(forest.edges)):
            forest.flatten()  # a pair whose members are all in one tree brings no new link
            tree = forest.parent
            change = np.concatenate([[0], np.cumsum(tree[1:] != tree[:-1])])
            one = (change[pairs[:, 1] - 1] == change[pairs[:, 0]]) & (change[pairs[:, 3] - 1] == change[pairs[:, 2]]) & (tree[pairs[:, 0]] == tree[pairs[:, 2]])
            pairs, diff = pairs[~one], diff[~one]
        if not len(pairs) or depth == BITS:
            continue
        zero = before(depth)
        a, a_end, b, b_end = pairs.T
        a_mid, b_mid = a + zero[a_end] - zero[a], b + zero[b_end] - zero[b]
        own = a == b
        ways = [(a, a_mid, b, b_mid, diff, None), (a_mid, a_end, b_mid, b_end, diff, None), (a, a_mid, b_mid, b_end, diff + 1, None), (a_mid, a_end, b, b_mid, diff + 1, ~own)]
        found, errors = [], []
        for w, x, y, z, d, only in ways:
            keep = (w < x) & (y < z) & (d <= budget)
            if only is not None:
                keep &= only
            found.append(np.stack([w, x, y, z], axis=1)[keep])
            errors.append(d[keep])
        stack.append((depth + 1, np.concatenate(found), np.concatenate(errors)))
    return forest.edges


def _slices(each: np.ndarray) -> Iterator[slice]:
    """Slices whose sums stay near STEP_PAIRS."""
    if not len(each):
        return
    ends = np.cumsum(each)
    cuts = np.searchsorted(ends, np.arange(STEP_PAIRS, ends[-1] + STEP_PAIRS, STEP_PAIRS), side="left") + 1
    start = 0
    for stop in np.unique(np.minimum(cuts, len(each))).tolist():
        yield slice(start, stop)
        start = stop


def blocks_fixed(n: int, budget: int = BUDGET, most: int = 3) -> int:
    """Number of blocks that a subtrie fixes for n distinct fingerprints."""
    for k in range(1, most):
        if n / 2 ** (BITS * k / (budget + k)) <= SUBTRIE_ROWS:
            return k
    return most


def masks(k: int, budget: int = BUDGET) -> list[int]:
    """Bit masks of all choices of k among budget + k blocks of bits."""
    m = budget + k
    ends = [BITS * i // m for i in range(m + 1)]
    block = [((1 << (ends[i + 1] - ends[i])) - 1) << (BITS - ends[i + 1]) for i in range(m)]
    out = [sum(block[i] for i in c) for c in combinations(range(m), k)]
    assert len(out) == comb(m, k)
    return out


def blocks_of(mask: int, n: int) -> list[int]:
    """The bits of a mask in n blocks of nearly equal size, as masks."""
    bits = [i for i in range(BITS) if mask >> i & 1]
    return [sum(1 << i for i in bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def _walk(budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (choice, prefix, tile, side, fp), ordered, to a spanning forest of each subtrie or pair of tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def walked(rows: np.ndarray) -> pa.RecordBatch:
            keys = np.ascontiguousarray(rows[:, 4]).view(np.uint64)
            new = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            cuts = [0, *new.tolist(), len(rows)]
            roots, last = [], None
            for a, b in zip(cuts, cuts[1:], strict=False):
                group, side = tuple(rows[a, :3].tolist()), rows[a, 3]
                # fingerprints are ordered as signed numbers: negative ones, whose first bit is 1, come first
                neg = a + int(np.count_nonzero(rows[a:b, 4] < 0))
                parts = [(x, y) for x, y in ((a, neg), (neg, b)) if x < y]
                if side == 0:
                    roots += [(x, y, x, y) for x, y in parts]
                    if len(parts) == 2:
                        roots.append((*parts[0], *parts[1]))
                elif side == 1:
                    last = (group, parts)
                elif last and last[0] == group:
                    roots += [(*p, *q) for p in last[1] for q in parts]
            edges = trie_join(keys, roots, budget)
            at = np.array(edges, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(rows[at[:, 0], 4]), pa.array(rows[at[:, 1], 4])], names=["a", "b"])

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
            size += batch.num_rows
            if size >= WALK_ROWS:
                rows = np.concatenate(held)
                group = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
                done = int(np.flatnonzero(group)[-1]) + 1 if group.any() else 0
                if done:
                    yield walked(rows[:done])
                held, size = [rows[done:]], len(rows) - done
        if held and size:
            yield walked(np.concatenate(held))

    return run


def links(distinct: DataFrame, budget: int = BUDGET, fixed: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that span every group of linked ones."""
    spark = distinct.sparkSession
    n = distinct.count()
    chosen = masks(fixed or blocks_fixed(n, budget), budget)
    spread = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("prefix")) for i, m in enumerate(chosen)))).alias("x")).select("fp", "x.*")
    zero, key = F.lit(0).cast("long"), ["choice", "prefix"]
    large = cut(spread.groupBy(*key).agg(F.count("*").alias("members")).where(F.col("members") > tile_rows), "simhash-large")
    order = ["choice", "prefix", "tile", "side", "fp"]
    rows = spread.select(*key, zero.alias("tile"), zero.alias("side"), "fp")
    if not large.isEmpty():
        # of budget + 1 blocks of the other bits linked members agree in one: each is a trie of its own, and far smaller
        deeper = ", ".join(f"array({', '.join(f'{signed(x)}L' for x in blocks_of(~m & (1 << BITS) - 1, budget + 1))})" for m in chosen)
        again = spread.join(large.select(*key), key).withColumn("x", F.explode(F.expr(f"transform(element_at(array({deeper}), choice + 1), (m, i) -> struct(i as sub, fp & m as more))")))
        again = cut(again.select(*key, "x.*", "fp"), "simhash-deeper")
        more = [*key, "sub", "more"]
        crowded = cut(again.groupBy(*more).agg(F.count("*").alias("members")).where(F.col("members") > tile_rows), "simhash-crowded")
        alone = again.join(crowded, more, "left_anti").select(*key, F.xxhash64("sub", "more").alias("tile"), zero.alias("side"), "fp")
        tiles = again.join(crowded, more).withColumn("n", F.ceil(F.col("members") / (tile_rows / 2))).withColumn("own", F.pmod(F.xxhash64("fp"), "n"))
        met = tiles.withColumn("other", F.explode(F.sequence(zero, F.col("n") - 1)))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2).cast("long")
        cut_up = met.select(*key, F.xxhash64("sub", "more", low, high).alias("tile"), side.alias("side"), "fp")
        rows = rows.join(large, key, "left_anti").select(*order).unionByName(alone).unionByName(cut_up)
    dealt = rows.repartition(partitions(spark), "choice", "prefix", "tile").sortWithinPartitions(*order)
    return dealt.select(*order).mapInArrow(_walk(budget), "a long, b long")


def join_spread(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """`many` joined to the one row of `one` for each key, which counts the key's rows in ``rows``.

    Keys of more than HOT_ROWS rows would each be one task; they are at most the rows of `many` / HOT_ROWS, and are broadcast.
    """
    hot = F.broadcast(one.where(F.col("rows") > HOT_ROWS).drop("rows"))
    rest = many.join(hot.select(key), key, "left_anti").join(one.where(F.col("rows") <= HOT_ROWS).drop("rows"), key)
    return many.join(hot, key).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``: root is the smallest node of its component.

    Large-star and small-star steps in turn until nothing changes; every step's edges are written out, so a
    long chain costs a logarithmic number of steps and no lineage.
    """
    one_way = lambda e: e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = cut(one_way(edges), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows")).select("a", F.least("a", "m").alias("m"), "rows"), "edges-least")
        large = join_spread(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = cut(one_way(large), "edges-large")
        small_least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(small_least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small_least.select("a", F.col("m").alias("b")))
        now = cut(one_way(small), "edges-small")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == before:
            break
        before = (state["n"], state["s"])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


#: Rows in order: by id with null last, then text.
_ORDER = ("doc_id is null as none", "doc_id", "text_hash")


def order() -> Column:
    return F.struct(*map(F.expr, _ORDER))


def placed(docs: DataFrame, distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp, root, first``: first is the first row of the component, as a struct of _ORDER. `distinct` has ``fp, first, rows``."""
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"), F.col("rows").alias("members"))
    named = cut(named, "placed-fingerprints")
    firsts = named.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("rows"))
    known = cut(join_spread(named.select("fp", "root", "members"), firsts, "root").withColumnRenamed("members", "rows"), "placed-roots")
    return join_spread(docs, known, "fp").select("doc_id", "text_hash", "fp", "root", "first")


def _placed(df: DataFrame, id_col: str, text_col: str, budget: int) -> DataFrame:
    docs = cut(fingerprints(df, id_col, text_col), "fingerprints")
    distinct = cut(docs.groupBy("fp").agg(F.min(order()).alias("first"), F.count("*").alias("rows")), "distinct-fingerprints")
    return placed(docs, distinct, components(links(distinct.select("fp"), budget)))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """Component of every row under links between fingerprints of `budget` or fewer differing bits.

    Returns ``doc_id, text_hash, fp, root, component_id``: one row for each row of ``df``; root is a fingerprint
    that stands for the component, component_id the smallest doc_id in it (null only where no row of the
    component has an id). Null and empty texts and texts without words have fingerprint 0 and link like any
    other; rows of equal text or id stay rows of their own; an empty table gives no rows. Only the named
    columns of ``df`` are read.
    """
    return _placed(df, id_col, text_col, budget).select("doc_id", "text_hash", "fp", "root", F.col("first.doc_id").alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """The rows of ``df`` that stand for their component: the one of smallest doc_id (null last), then text hash.

    All columns stay as they are. Of rows equal in id and text one is kept. The rows that go are joined by id and
    text hash: broadcast up to BROADCAST_ROWS of them, else in an exchange of all texts.
    """
    return kept(df, _placed(df, id_col, text_col, budget), id_col, text_col)


def kept(df: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that are the first of their component in what `placed` returns."""
    gone = cut(found.where(~order().eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "not-kept")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    rows = df.join(gone, df[id_col].eqNullSafe(gone["__id"]) & F.xxhash64(df[text_col]).eqNullSafe(gone["__hash"]), "left_anti")
    copies = found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count()
    if not copies:
        return rows
    held = rows.select(F.struct(*columns(rows)).alias("row"), rows[id_col].alias("__id"), F.xxhash64(rows[text_col]).alias("__hash"))
    return held.groupBy("__id", "__hash").agg(F.first("row").alias("row")).select("row.*")
