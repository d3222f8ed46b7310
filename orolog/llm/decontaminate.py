"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

Texts are normalised to lower-case words (A-Z lowered; a word is a run of digits, ASCII letters and code points
from U+0080). Every distinct benchmark word is numbered and written in a few digits, any other word as one sign. The
automaton holds, in that writing, anchors: runs of ANCHOR words that begin at every (WINDOW - ANCHOR + 1)-th word of
an item, so that each window of WINDOW consecutive words has a whole anchor in it; items shorter than a window stand in
it whole. Each document is scanned once; an anchor that occurs gives the few windows that it can lie in, and these are
looked up among the item's windows by hash and compared word by word. Word numbers map to offsets of the original text.

Anchors take about a sixth of the memory that all windows would. Still an automaton's size follows the benchmark's, so
it is checked: it holds BLOCK_CHARS characters of items. A larger benchmark has several, and a task reads HELD_BYTES of
documents and takes them through one automaton after another: documents are read once, and no text is written.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orolog.llm._shared import SLICE_ROWS, held, map_batches

WINDOW = 10
#: Words of an anchor.
ANCHOR = 4
#: Characters of benchmark text in one automaton (about 40 times that in bytes of memory).
BLOCK_CHARS = 4_000_000
#: Bytes of documents that a task holds where there are several automata.
HELD_BYTES = 64_000_000
#: How words are written: one sign for words that no item has, else digits, of which the first has signs of its own.
OTHER, FIRST, REST, BASE = "\x01", 0x100, 0x200, 64

#: Byte table of the normalisation: A-Z to a-z, other ASCII outside words to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Windows:
    """The distinct windows of numbered texts, with the items that have each; found by hash, compared word by word."""

    def __init__(self, texts: list[np.ndarray], owners: list[int], width: int) -> None:
        self.width = width
        self.words = np.concatenate([np.zeros(0, np.int64), *texts])
        ends = np.cumsum([len(t) for t in texts])
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(e - len(t), e - width + 1) for t, e in zip(texts, ends, strict=True))])
        who = np.concatenate([np.zeros(0, np.int64), *(np.full(len(t) - width + 1, o) for t, o in zip(texts, owners, strict=True))])
        keys = self.hashes(self.words)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.who = keys[order], at[order], who[order]

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        """A hash of every window."""
        n = len(numbers) - self.width + 1
        out = np.zeros(max(0, n), dtype=np.uint64)
        for k in range(self.width):
            out = (out ^ numbers[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def find(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the starts those at which a window occurs, and the distinct owners of these windows."""
        keys = self.hashes(numbers)[starts]
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found, owners = np.zeros(len(starts), dtype=bool), [np.zeros(0, np.int64)]
        seen: set[tuple[int, int]] = set()
        for k in np.flatnonzero(low < high).tolist():
            span = (int(low[k]), int(high[k]))
            mine = numbers[starts[k] : starts[k] + self.width]
            here = self.at[span[0] : span[1]]
            if span in seen and (self.words[here[0] : here[0] + self.width] == mine).all():  # repeated windows are compared once
                found[k] = True
                continue
            same = (self.words[here[:, None] + np.arange(self.width)] == mine).all(axis=1)
            if same.any():
                found[k] = True
                owners.append(self.who[span[0] : span[1]][same])
                if same.all():
                    seen.add(span)
        return starts[found], np.unique(np.concatenate(owners))


class Scanner:
    """The automaton over (item id, text) pairs; it is built where it is used and reads each text once."""

    def __init__(self, items: Iterable[tuple[object, str | None]], width: int = WINDOW) -> None:
        import ahocorasick

        listed = [("null" if key is None else str(key), words(text)) for key, text in items]
        number: dict[bytes, int] = {}
        for _, w in listed:
            for x in w:
                number.setdefault(x, len(number))
        digits = 1
        while BASE**digits < len(number):
            digits += 1
        self.number = number
        self.writing = {x: "".join(chr((REST if k else FIRST) + n // BASE**k % BASE) for k in range(digits)) for x, n in number.items()}
        self.names = sorted({who for who, _ in listed})
        place = {who: i for i, who in enumerate(self.names)}
        anchor = min(ANCHOR, width)
        self.stride = width - anchor + 1
        texts: list[np.ndarray] = []
        owners: list[int] = []
        short: dict[str, tuple[int, set[int]]] = {}
        anchors: set[str] = set()
        for who, w in listed:
            written = [self.writing[x] for x in w]
            if len(w) >= width:
                texts.append(np.array([number[x] for x in w], dtype=np.int64))
                owners.append(place[who])
                anchors.update("".join(written[i : i + anchor]) for i in range(0, len(w) - anchor + 1, self.stride))
            elif w:
                short.setdefault("".join(written), (len(w), set()))[1].add(place[who])
        self.windows = Windows(texts, owners, width)
        self.automaton = ahocorasick.Automaton()
        for pattern in anchors | short.keys():
            n, who = short.get(pattern, (0, ()))
            self.automaton.add_word(pattern, (anchor if pattern in anchors else 0, n, frozenset(who)))
        if anchors or short:
            self.automaton.make_automaton()
        self.empty = not (anchors or short)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, merged word ranges [first, end) that are hit, and the items with occurring windows."""
        w = words(text)
        if self.empty or not w:
            return len(w), [], set()
        written = list(map(self.writing.get, w, repeat(OTHER)))
        ranges: list[tuple[int, int]] = []
        items: set[int] = set()
        maybe: list[int] = []
        ends = None
        for end, (anchor, n, who) in self.automaton.iter("".join(written)):
            if ends is None:
                ends = list(accumulate(map(len, written)))
            last = bisect_right(ends, end) + 1
            if n:
                ranges.append((last - n, last))
                items |= who
            if anchor:
                maybe.append(last - anchor)
        if maybe:
            starts = (np.array(maybe)[:, None] - np.arange(self.stride)).ravel()
            starts = np.unique(starts[(starts >= 0) & (starts <= len(w) - self.windows.width)])
            hit, owners = self.windows.find(np.array([self.number.get(x, -1) for x in w], dtype=np.int64), starts)
            ranges += [(a, a + self.windows.width) for a in hit.tolist()]
            items |= set(owners.tolist())
        return len(w), merged(ranges), {self.names[i] for i in items}


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges [first, end), in order."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def source_spans(text: str | None, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans of the original text that cover the given word ranges."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text or "")]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def removed(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the hit passages; what stood around them is joined by a space where words would meet."""
    out, at = [], 0
    for a, b in source_spans(text, ranges):
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return " ".join(x.strip() for x in out if x.strip())


def digest(items: set[str] | list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of a checked size.

    The benchmark comes to the driver a partition at a time and one block at most is held; an item longer than a
    block is a block. An empty benchmark is one empty block.
    """
    block: list[tuple] = []
    size = 0
    for r in benchmark.select(benchmark[id_col].alias("i"), benchmark[text_col].alias("t")).where("t is not null").toLocalIterator():
        if block and size + len(r["t"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += len(r["t"])
    yield block


def _scanner(key: str, shared, width: int) -> Scanner:
    """The automaton of one block that tasks of this process share; one at a time is held."""
    return held(key, lambda: Scanner(shared.value, width))


def _shared_blocks(df: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, block_chars: int) -> list[tuple]:
    """(key, broadcast) of every block, each of block_chars at most; tasks build one automaton at a time from them."""
    context = df.sparkSession.sparkContext
    return [(uuid.uuid4().hex, context.broadcast(block)) for block in blocks(benchmark, item_col, item_text_col, block_chars)]


def _scanned(batches: Iterable[pa.RecordBatch], at: int, parts: list[tuple], width: int) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Every batch with what `scan` gives for its texts in column `at`, over all blocks."""

    def through(waiting: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
        found: list[list] = [[None] * b.num_rows for b in waiting]
        for key, shared in parts:
            scanner = _scanner(key, shared, width)
            for batch, row in zip(waiting, found, strict=True):
                for i, text in enumerate(batch.column(at)):
                    n, ranges, items = scanner.scan(text.as_py())
                    if row[i] is not None and (ranges or row[i][1]):
                        ranges, items = merged([*ranges, *row[i][1]]), items | row[i][2]
                    row[i] = (n, ranges, items)
        yield from zip(waiting, found, strict=True)

    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if len(parts) == 1 or size >= HELD_BYTES:
            yield from through(waiting)
            waiting, size = [], 0
    yield from through(waiting)


def find_overlap(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Benchmark words in every row of ``df``.

    Returns ``doc_id, n_words, n_hit, n_items, items, ranges`` with one row for each row of ``df``: the hit
    words, the distinct items with an occurring window (a null item id counts as 'null'), and the hit word
    ranges. Null and empty texts have no words and items without words no windows; an empty benchmark hits
    nothing; repeated rows and repeated items are treated alike; an empty table gives no rows. Only the named
    columns are read, and texts of any length are read once.
    """
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL("n_words long, n_hit long, n_items long, items array<string>, ranges array<struct<first: int, end: int>>").fields])
    arrow = to_arrow_schema(schema)
    parts = _shared_blocks(df, benchmark, item_col, item_text_col, block_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS))
        for batch, found in _scanned(small, 1, parts, width):
            out = [[n for n, _, _ in found], [sum(b - a for a, b in r) for _, r, _ in found], [len(i) for *_, i in found], [sorted(i) for *_, i in found], [[{"first": a, "end": b} for a, b in r] for _, r, _ in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow[0].type), *(pa.array(v, f.type) for v, f in zip(out, list(arrow)[1:], strict=True))], schema=arrow)

    return map_batches(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), run, schema)


def drop_overlap(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``df`` in whose text no benchmark window occurs; all columns as they are."""
    at = df.columns.index(text_col)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    parts = _shared_blocks(df, benchmark, item_col, item_text_col, block_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scanned(batches, at, parts, width):
            yield batch.filter(pa.array([not ranges for _, ranges, _ in found], pa.bool_()))

    return map_batches(plain, run, plain.schema).toDF(*df.columns)
