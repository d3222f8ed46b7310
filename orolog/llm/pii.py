"""Personal data: plain detectors, and offset-preserving deobfuscation before the same detectors.

A disguised stretch is rewritten by transducers that keep, for every character they put out, the span of source
characters it stands for: homoglyphs and wide forms become ASCII, zero-width characters vanish, at and dot
disguises become @ and ., and runs of spelled digits become digits. The detectors then read the rewritten
stretch, and what they find is mapped back to source offsets. Found spans that contain no rewritten character
are left out, as are those that overlap a span of the same kind in the plain text without holding all of it: the
plain spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orolog.llm._shared import map_rows

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: From the start of a run of digits on: later starts in the run would end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9]|@")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, looked for around each @ so that long words cost nothing."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def plain(text: str) -> list[Span]:
    """Spans (kind, start, end) by kind, then start; offsets are code points."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


# Letters of other scripts that look like ASCII ones, written side by side.
_LOOKALIKES = (
    ("авекмнорстухіјѕԁһԛԝ", "abekmhopctyxijsdhqw"),
    ("АВЕКМНОРСТУХІЈЅ", "ABEKMHOPCTYXIJS"),
    ("αβεικνορτυχ", "abeiknoptux"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
    ("٠١٢٣٤٥٦٧٨٩", "0123456789"),
    ("०१२३४५६७८९", "0123456789"),
    ("‐‑‒–−。․﹒", "-----..."),
)
GLYPHS = {a: b for one, other in _LOOKALIKES for a, b in zip(one, other, strict=True)}
GLYPHS |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}  # wide forms
GLYPHS |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}  # mathematical digits
GLYPHS |= {c: "" for c in "\u200B\u200C\u200D\u2060\uFEFF\u00AD"}  # nothing to see
# Digits 0 to 9 spelled in four languages.
_SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGITS = {w: str(i) for line in _SPELLED for i, w in enumerate(line.split())} | {"oh": "0"}
#: Spelled digits in a row that are taken for a number.
LEAST_SPELLED = 4

_GLYPH = "[" + re.escape("".join(GLYPHS)) + "]"
_ODD = re.compile(f"(?:(?<=[A-Za-z0-9@._+-]){_GLYPH}|{_GLYPH}(?=[A-Za-z0-9@._+-])|[０-９＠\U0001d7ce-\U0001d7ff٠-٩०-९])")
_DIGIT = "(?:" + "|".join(sorted(map(re.escape, DIGITS), key=len, reverse=True)) + ")"
_SPELLED_DIGIT = re.compile(rf"(?<![^\W_]){_DIGIT}(?![^\W_])", re.IGNORECASE)
_AT_WORD, _DOT_WORD = r"(?:at|arroba|chez)", r"(?:dot|punkt|point|punto)"
_SPOKEN_AT = r"(?:at|arroba)"
_OPEN, _CLOSE = r"[(\[{<]\x20?", r"\x20?[)\]}>]"
_GAP = r"(?:\x20{1,3}|[_-])"
#: What may stand between two spelled digits: separators, or a dot that is spoken or in brackets.
_SEP, _DOT_SEP = r"[\x20,.-]{1,3}", rf"(?:\x20{{0,2}}{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}\x20{{0,2}}|{_GAP}{_DOT_WORD}{_GAP})"
_BETWEEN = re.compile(rf"(?P<dot>{_DOT_SEP})|{_SEP}", re.IGNORECASE)
#: A sign of an address: in brackets, spoken, or as it is. Spaces are counted, so that every text takes linear time.
_SIGN = re.compile(
    rf"\x20{{0,2}}{_OPEN}(?:(?P<held_at>{_AT_WORD}|@)|(?P<held_dot>{_DOT_WORD}|\.)){_CLOSE}\x20{{0,2}}"
    rf"|(?<=[A-Za-z0-9]){_GAP}(?:(?P<said_at>{_SPOKEN_AT})|(?P<said_dot>{_DOT_WORD})){_GAP}(?=[A-Za-z0-9])"
    rf"|(?P<plain_at>@)|(?<=[A-Za-z0-9])(?P<plain_dot>\.)(?=[A-Za-z0-9])",
    re.IGNORECASE,
)
_ATOM = re.compile(r"[A-Za-z0-9_%+-]+")
_ATOM_CHARS = _LOCAL_CHARS - {"."}
# Last labels by which a spoken address is told from a sentence.
_LAST = frozenset(
    "com net org edu gov mil int info biz name pro io co ai app dev me tv eu us uk ca au nz ie in de at ch fr be nl lu es mx ar it pt br pl cz se no fi dk ru jp cn kr "
    "online site xyz tech store shop club cloud blog live world email mail web page software systems agency digital example test local".split()
)
#: Cheap signs, over the lower-cased text with a space before it, that a disguise may follow.
_RUN_HINT = re.compile(rf"[^\w]{_DIGIT}(?:{_SEP}|{_DOT_SEP}){_DIGIT}(?:{_SEP}|{_DOT_SEP}){_DIGIT}", re.ASCII)
_ODD_HINT = re.compile("[\u00ad\u0300-\u1fff\u2000-\u2fff\u3000-\uffff\U0001d000-\U0001dfff]")
_DOT_HINT = re.compile(rf"[\x20_-]{_DOT_WORD}[\x20_-]")
_HELD_HINT = re.compile(rf"{_OPEN}(?:{_AT_WORD}|{_DOT_WORD}|[@.]){_CLOSE}")
_PLUS_WORD = re.compile(r"\bplus\x20(?=[0-9])", re.IGNORECASE)
#: Characters on either side of a disguise that are rewritten with it; the stretch then grows to white space.
AROUND = 96
Edit = tuple[int, int, str]


class Tape:
    """Text with the source span of each of its characters; rewriting keeps them."""

    def __init__(self, text: str, offset: int) -> None:
        self.text = text
        self.start = list(range(offset, offset + len(text)))
        self.end = [x + 1 for x in self.start]
        self.made = [False] * len(text)

    def replace(self, edits: list[Edit]) -> None:
        """Put strings in place of stretches [a, b), given in order; each new character stands for its whole stretch."""
        if not edits:
            return
        text, start, end, made, at = [], [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[b - 1]] * len(new)
            made += self.made[at:a] + [True] * len(new)
            at = b
        text.append(self.text[at:])
        self.text, self.start, self.end, self.made = "".join(text), start + self.start[at:], end + self.end[at:], made + self.made[at:]


def _glyph_edits(text: str) -> list[Edit]:
    return [(i, i + 1, GLYPHS[c]) for i, c in enumerate(text) if c in GLYPHS]


def _spelled_edits(text: str) -> list[Edit]:
    """Runs of LEAST_SPELLED or more spelled digits as digits; a spoken dot between two of them becomes a dot."""
    out: list[Edit] = []
    run: list[Edit] = []
    before = None
    for m in [*_SPELLED_DIGIT.finditer(text), None]:
        gap = None
        if m is not None and before is not None and m.start() - before.end() < 16:
            gap = _BETWEEN.fullmatch(text, before.end(), m.start())
        if gap is not None:
            a, _, digit = run[-1]
            run[-1] = (a, m.start(), digit + "." * bool(gap["dot"]))
        else:
            out += run if len(run) >= LEAST_SPELLED else []
            run = []
        if m is not None:
            run.append((*m.span(), DIGITS[m[0].lower()]))
        before = m
    return out


def _chains(text: str) -> Iterator[tuple[list[str], list[tuple[int, int, str, str]]]]:
    """Atoms and the signs (start, end, 'at' or 'dot', how it is written) between them, joined as far as signs and atoms alternate."""
    atoms: list[str] = []
    signs: list[tuple[int, int, str, str]] = []

    def closed() -> tuple[list[str], list[tuple[int, int, str, str]]]:
        behind = _ATOM.match(text, signs[-1][1])
        return [*atoms, behind[0] if behind else ""], signs

    for m in _SIGN.finditer(text):
        how, what = m.lastgroup.split("_")
        if signs and _ATOM.fullmatch(text, signs[-1][1], m.start()):
            atoms.append(text[signs[-1][1] : m.start()])
        else:
            start, free = m.start(), 0
            if signs:
                yield closed()
                free = signs[-1][1]
            while start > free and text[start - 1] in _ATOM_CHARS:
                start -= 1
            atoms, signs = [text[start : m.start()]], []
        signs.append((*m.span(), what, how))
    if signs:
        yield closed()


def _addresses(atoms: list[str], signs: list[tuple[int, int, str, str]]) -> set[int]:
    """Places of the signs that make up e-mail addresses, at least one sign of each disguised.

    An address behind a spoken at, or with a spoken last dot and no at in brackets, ends in one of the known labels; behind
    a spoken at one of its dots is disguised as well, since "at example.com" is ordinary prose.
    """
    used: set[int] = set()
    free = 0
    for j, (_, _, what, at_how) in enumerate(signs):
        if what != "at" or j < free or not atoms[j] or not atoms[j + 1]:
            continue
        first = j
        while first > free and signs[first - 1][2] == "dot" and atoms[first - 1]:
            first -= 1
        last = j
        while last + 1 < len(signs) and signs[last + 1][2] == "dot" and atoms[last + 2]:
            last += 1
        for r in range(last, j, -1):
            label, how = atoms[r + 1].lower(), signs[r][3]
            strict = at_how == "said" or (how == "said" and at_how != "held")
            if not (label in _LAST if strict else label.replace("-", "").isalnum() and (how == "plain" or (label.isalpha() and len(label) > 1))):
                continue
            kinds = {signs[k][3] for k in range(j + 1, r + 1)}
            if kinds != {"plain"} or (at_how != "said" and (at_how == "held" or any(signs[k][3] != "plain" for k in range(first, j)))):
                used |= set(range(first, r + 1))
                free = r + 1
                break
    return used


def _numbers(atoms: list[str], signs: list[tuple[int, int, str, str]]) -> set[int]:
    """Places of the dots between four or more numbers of up to three digits."""
    used: set[int] = set()
    run: list[int] = []
    short = [len(a) <= 3 and a.isdigit() for a in atoms]
    for j, sign in enumerate(signs):
        if sign[2] == "dot" and short[j] and short[j + 1]:
            run.append(j)
        else:
            used |= set(run) if len(run) >= 3 else set()
            run = []
    return used | (set(run) if len(run) >= 3 else set())


def _sign_edits(text: str) -> list[Edit]:
    """At and dot disguises of addresses, and dots between numbers, as the signs themselves."""
    out: list[Edit] = []
    for atoms, signs in _chains(text):
        if all(s[3] == "plain" for s in signs):
            continue
        for k in sorted(_addresses(atoms, signs) | _numbers(atoms, signs)):
            a, b, what, how = signs[k]
            if how != "plain":
                out.append((a, b, "@" if what == "at" else "."))
    return out


def _plus_edits(text: str) -> list[Edit]:
    return [(*m.span(), "+") for m in _PLUS_WORD.finditer(text)]


#: The transducers, in the order in which they rewrite.
REWRITES = (_glyph_edits, _spelled_edits, _sign_edits, _plus_edits)


def _disguises(text: str) -> list[tuple[int, int]]:
    """Stretches of the text that hold a disguise, merged and grown to white space."""
    seen = [m.span() for m in _ODD.finditer(text)] if not text.isascii() and _ODD_HINT.search(text) else []
    lower = " " + text.lower()
    if _DOT_HINT.search(lower) or (any(c in text for c in "([{<") and _HELD_HINT.search(lower)):
        seen += [e[:2] for e in _sign_edits(text)]
    if _RUN_HINT.search(lower):
        seen += [e[:2] for e in _spelled_edits(text)]
    if "plus " in lower:
        seen += [e[:2] for e in _plus_edits(text)]
    out: list[list[int]] = []
    for a, b in sorted(seen):
        a, b, past = max(0, a - AROUND), min(len(text), b + AROUND), out[-1][1] if out else 0
        if out and b <= past:
            continue
        while a > past and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if out and a <= past:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def disguised(text: str, known: list[Span]) -> list[Span]:
    """Spans that only show after rewriting, in source offsets. Of its kind each touches no known span, or holds all that it touches and more."""
    found: list[Span] = []
    spans = [[(x, y) for k, x, y in known if k == kind] for kind in range(len(KINDS))]  # in order, and apart
    starts, ends = ([[s[k] for s in one] for one in spans] for k in (0, 1))
    for a, b in _disguises(text):
        tape = Tape(text[a:b], a)
        for rewrite in REWRITES:
            tape.replace(rewrite(tape.text))
        changed = [0, *accumulate(tape.made)]
        for kind, s, e in plain(tape.text):
            span = (kind, tape.start[s], tape.end[e - 1])
            if changed[e] == changed[s] and span[2] - span[1] == e - s:
                continue
            at, stop = bisect_right(ends[kind], span[1]), bisect_left(starts[kind], span[2])
            if at == stop or (span[1] <= spans[kind][at][0] and spans[kind][stop - 1][1] <= span[2] and span[1:] != spans[kind][at]):
                found.append(span)
    return found


def detect(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain and added spans of a whole text; a null text counts as empty."""
    text = text or ""
    base = sorted(plain(text))
    return base, sorted(set(disguised(text, base)))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stands."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
            at = b
    return "".join([*out, text[at:]])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row's whole text.

    Returns ``doc_id``, a count for each kind of plain span, ``n_added, base, spans`` (the latter two written as
    kind:start:end by kind, then start), one row for each row of ``df``. Null and empty texts have no spans;
    repeated rows are read alike; an empty table gives no rows. Only the named columns are read.
    """
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *T.StructType.fromDDL(", ".join(f"n_{k} long" for k in KINDS) + ", n_added long, base string, spans string").fields])

    def make() -> Callable[..., list[list]]:
        def step(ids: list, texts: list) -> list[list]:
            rows = []
            for i, t in zip(ids, texts, strict=True):
                base, added = detect(t)
                rows.append((i, *(sum(s[0] == k for s in base) for k in range(len(KINDS))), len(added), written(base), written(base + added)))
            return [list(x) for x in zip(*rows, strict=True)]

        return step

    return map_rows(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), schema, make)


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
