"""Secret scans, on DataFrame functions alone.

Base rules are regular expressions whose offsets come from the gaps between matches. To them the scan adds
tokens that look random: two character Markov chains, one of random strings and one of ordinary identifiers,
are trained by counting character pairs in labelled samples; a token is reported if the log-likelihood ratio
of the two chains reaches LEAST_RATIO in all and LEAST_MEAN a pair. Of a token that doesn't, such as a path of
ordinary words with a key at its end, the stretch that exceeds LEAST_MEAN by most is reported if it has the length
of a token and LEAST_STRETCH.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that a token may have; a chain's states.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_TOKEN = r"[A-Za-z0-9+/_-]"
LEAST_TOKEN = 16
#: Nats; both limits have to be reached.
LEAST_RATIO = 12.0
LEAST_MEAN = 0.35
#: Nats that a stretch within a token needs: more, as it is the best of many.
LEAST_STRETCH = 20.0

#: Labelled samples: this many random strings, and the words of this many documents.
SAMPLE_STRINGS = 20_000
SAMPLE_DOCS = 400


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KINDS = ("assign", "access", "hex")
ADDED = "random"
ASSIGN = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
#: The same spans as runs of any length that are dropped below 24.
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
LEAST_VALUE, LEAST_ACCESS = 6, 20

_SPAN = "array<struct<start: int, kind: int, end: int>>"
_SPLIT = f"(?<!{_TOKEN})(?={_TOKEN}{{{LEAST_TOKEN}}})"
_HEAD = f"^{_TOKEN}{{{LEAST_TOKEN},}}"


def _numbers(values: list, kind: str) -> Column:
    """A constant array, built by the optimizer from one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _running(values: Column, first: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array under an associative `join` with the neutral element `first`.

    Doubling: step k joins every element with the one 2**k places before it. A fold that appends to its result
    would copy it at each element; this takes n log n for n elements, and `values` is worked out once.
    """

    def step(done: Column, gap: Column) -> Column:
        shifted = F.concat(F.array_repeat(first, gap), F.slice(done, 1, F.size(done) - gap))
        return F.when(F.size(done) > gap, F.zip_with(shifted, done, join)).otherwise(done)

    return F.aggregate(_numbers([1 << k for k in range(31)], "int"), values, step)


def _placed(parts: Column, kind: str) -> Column:
    """Parts with `end`, at first the length of the text that each stands for, as its place in the whole text. `kind` is the type of a part."""
    none = F.from_json(F.lit("{}"), kind).withField("end", F.lit(0))
    return _running(parts, none, lambda a, b: b.withField("end", a["end"] + b["end"]))


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Spans of all leftmost non-overlapping matches whose value has `least` characters; offsets are code points."""

    def part(gap: Column, match: Column) -> Column:
        value = F.regexp_extract(match, pattern, value_group) if value_group else match
        return F.struct((F.length(gap) + F.length(match)).alias("end"), F.length(match).alias("size"), F.length(value).alias("value"))

    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), part)
    parts = F.filter(parts, lambda x: x["size"].isNotNull())  # there is one gap more than there are matches
    good = F.filter(_placed(parts, "end int, size int, value int"), lambda x: x["value"] >= least)
    return F.transform(good, lambda x: F.struct((x["end"] - x["size"]).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))).cast(_SPAN)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of characters, from samples ``(text string, is_secret boolean)``.

    Pairs with other characters are left out; null texts and labels count for nothing. Counts are smoothed by
    half a pair, so that an empty table gives ratios of zero.
    """
    n = len(ALPHABET)
    counted = samples.where("text is not null and is_secret is not null and length(text) > 1").groupBy("text", "is_secret").count()
    spread = counted.repartition(counted.sparkSession.sparkContext.defaultParallelism)  # few bytes, but many pairs to take apart
    chars = spread.select("is_secret", "count", F.split("text", "").alias("c"))
    code = lambda c: F.instr(F.lit(ALPHABET), c)
    pairs = chars.select("is_secret", "count", F.explode(F.arrays_zip(F.col("c").alias("a"), F.expr("slice(c, 2, size(c))").alias("b"))).alias("p")).where("p.b is not null")
    known = pairs.groupBy("is_secret", "p.a", "p.b").agg(F.sum("count").alias("count")).select("is_secret", code(F.col("a")).alias("a"), code(F.col("b")).alias("b"), "count")
    counted = known.where("a > 0 and b > 0").collect()  # twice the square of the alphabet at most
    count = {(r["is_secret"], r["a"], r["b"]): r["count"] for r in counted}
    total = {(s, a): sum(count.get((s, a, b), 0) for b in range(1, n + 1)) for s in (True, False) for a in range(1, n + 1)}
    p = lambda s, a, b: (count.get((s, a, b), 0) + 0.5) / (total[s, a] + 0.5 * n)
    return [log(p(True, a, b) / p(False, a, b)) for a in range(1, n + 1) for b in range(1, n + 1)]


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled random strings in the usual alphabets, from hashes of 0 to n - 1."""
    h = F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256))
    plain = F.regexp_replace(F.base64(h), "[=\r\n]", "")
    text = (
        F.when(F.col("id") % 4 == 0, F.regexp_replace(plain, "[+/]", ""))
        .when(F.col("id") % 4 == 1, plain)
        .when(F.col("id") % 4 == 2, F.lower(F.hex(h)))
        .otherwise(F.upper(F.regexp_replace(plain, "[+/]", "")))
    )
    return spark.range(n).select(text.alias("text"), F.lit(True).alias("is_secret"))


def ordinary_identifiers(docs: DataFrame, n_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled identifiers: words of a bounded sample of documents as they stand and joined in the usual styles.

    The `n_docs` ids of the lowest hashes are looked for among those below a limit that about four times as many rows pass.
    """
    ids = docs.select(docs[id_col].alias("i")).where("i is not null")
    limit = int(min(1.0, 4 * n_docs / max(1, docs.count())) * 2**40)
    chosen = ids.where(F.pmod(F.xxhash64("i"), F.lit(2**40)) < F.lit(limit)).distinct().orderBy(F.pmod(F.xxhash64("i"), F.lit(2**40)), "i").limit(n_docs).collect()  # n_docs ids
    texts = docs.where(docs[id_col].isin([r["i"] for r in chosen])).groupBy(docs[id_col]).agg(F.min(docs[text_col]).alias("text"))  # of rows of one id one text
    words = texts.select(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0)).alias("w"))
    pair = words.select(F.explode(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, greatest(size(w), 1))").alias("b"))).alias("p")).where("p.a is not null and p.b is not null")
    a, b = F.col("p.a"), F.col("p.b")
    styles = F.array(a, F.concat(a, F.lit("_"), b), F.concat(a, F.initcap(b)), F.concat(F.upper(a), F.lit("_"), F.upper(b)), F.concat(a, F.lit("-"), b, F.lit("-2")), F.concat(a, F.lit("/"), b, F.lit("/10")))
    return pair.select(F.explode(styles).alias("text"), F.lit(False).alias("is_secret"))


def _tokens(text: Column) -> Column:
    """Runs of at least LEAST_TOKEN token characters as (end, size, token). The text is cut before each of them, in one pass."""
    cut = F.transform(F.split(text, _SPLIT, -1), lambda x: F.struct(F.length(x).alias("end"), F.length(x).alias("whole"), F.regexp_extract(x, _HEAD, 0).alias("token")))
    runs = F.filter(_placed(cut, "end int, whole int, token string"), lambda x: x["token"] != "")
    return F.transform(runs, lambda x: F.struct((x["end"] - x["whole"]).alias("start"), x["token"].alias("token")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _scored(codes: Column, table: Column) -> Column:
    """Sum of the ratios of all pairs, and the stretch of pairs (first, last, from 1) whose ratios exceed LEAST_MEAN by most; one pass."""
    n = len(ALPHABET)
    pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: F.element_at(table, (a - 1) * n + b))
    whole, real = F.lit(0), F.lit(0.0)
    start = F.struct(whole.alias("at"), real.alias("total"), real.alias("now"), whole.alias("since"), real.alias("best"), whole.alias("first"), whole.alias("last"))

    def step(s: Column, ratio: Column) -> Column:
        at, goes_on = s["at"] + 1, s["now"] > 0
        now = F.when(goes_on, s["now"]).otherwise(0.0) + (ratio - LEAST_MEAN)
        since = F.when(goes_on, s["since"]).otherwise(at)
        better = now > s["best"]
        kept = lambda new, old: F.when(better, new).otherwise(s[old]).alias(old)
        return F.struct(at.alias("at"), (s["total"] + ratio).alias("total"), now.alias("now"), since.alias("since"), kept(now, "best"), kept(since, "first"), kept(at, "last"))

    return F.aggregate(pairs, start, step)


def _random_tokens(tokens: Column, ratios: list[float]) -> Column:
    """Spans of the tokens that look random as a whole, and of the best stretch of others, if that does."""
    table, codes = _numbers(ratios, "double"), _numbers([ALPHABET.find(chr(c)) + 1 for c in range(128)], "int")
    lettered = F.filter(tokens, lambda t: t["token"].rlike("[A-Za-z]"))

    def judged(t: Column) -> Column:
        numbers = F.transform(F.split(t["token"], ""), lambda c: F.element_at(codes, F.ascii(c) + 1))
        return F.struct(t["start"].alias("start"), F.length(t["token"]).alias("size"), _let(numbers, lambda c: _scored(c, table)).alias("s"))

    def span(t: Column) -> Column:
        s = t["s"]
        whole = s["total"] >= F.greatest(F.lit(LEAST_RATIO), LEAST_MEAN * (t["size"] - 1))
        pairs = s["last"] - s["first"] + 1
        part = (pairs >= LEAST_TOKEN - 1) & (s["best"] + LEAST_MEAN * pairs >= LEAST_STRETCH)
        made = lambda a, b: F.struct(a.alias("start"), F.lit(len(KINDS)).alias("kind"), b.alias("end"))
        return F.when(whole, made(t["start"], t["start"] + t["size"])).when(part, made(t["start"] + s["first"] - 1, t["start"] + s["last"] + 1))

    return F.filter(F.transform(F.transform(lettered, judged), span), lambda x: x.isNotNull()).cast(_SPAN)


def _apart(spans: Column) -> Column:
    """Of all spans those of the added kind that overlap no other kind's: sorted once, and compared with running ends and, from behind, starts."""
    added = lambda x: x["kind"] == len(KINDS)
    none = F.lit(None).cast("struct<start: int, kind: int, end: int>")

    def seen(items: Column, place: str, join: Callable[[Column, Column], Column]) -> Column:
        marked = F.transform(items, lambda x: F.struct(x.alias("x"), F.when(~added(x), x[place]).alias("m")))
        return _running(marked, F.struct(none.alias("x"), F.lit(None).cast("int").alias("m")), lambda a, b: b.withField("m", join(a["m"], b["m"])))

    clear = F.filter(seen(F.sort_array(spans), "end", F.greatest), lambda e: ~added(e["x"]) | e["m"].isNull() | (e["m"] <= e["x"]["start"]))
    back = F.reverse(F.transform(clear, lambda e: e["x"]))
    left = F.filter(seen(back, "start", F.least), lambda e: added(e["x"]) & (e["m"].isNull() | (e["m"] >= e["x"]["end"])))
    return F.reverse(F.transform(left, lambda e: e["x"])).cast(_SPAN)


def written(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, ADDED)))
    line = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), line), ",")


def find_secrets(df: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row's whole text.

    Returns ``doc_id, base, added`` with arrays of ``start, kind, end`` (kind: place in KINDS, then ADDED), one
    row for each row of ``df``. A null text counts as empty and has none; an added span never overlaps a base
    span; repeated rows are scanned alike; an empty table gives no rows. Only the named columns are read. Time
    grows in proportion to a text's length, however long its tokens are, and with n log n in the number of spans.
    """
    slim = df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    slim = slim.withColumn("tokens", _tokens(F.col("text")))
    text, tokens, none = F.col("text"), F.col("tokens"), F.array().cast(_SPAN)
    # cheap signs first: every access key and long hexadecimal run lies in a token
    assign = F.when((text.contains(":") | text.contains("=")) & text.rlike(ASSIGN), _matches(text, ASSIGN, 0, 2, LEAST_VALUE)).otherwise(none)
    access = F.when((F.size(tokens) > 0) & text.contains("AKIA"), _matches(text, ACCESS, 1, 0, LEAST_ACCESS)).otherwise(none)
    hexes = F.when(F.exists(tokens, lambda t: t["token"].rlike(HEX)), _matches(text, HEX, 2)).otherwise(none)
    found = slim.select("doc_id", F.concat(assign, access, hexes).alias("base"), F.when(F.size(tokens) > 0, _random_tokens(tokens, ratios)).otherwise(none).alias("random"))
    added = F.when(F.size("random") == 0, none).when(F.size("base") == 0, F.col("random")).otherwise(_apart(F.concat("base", "random")))
    return found.select("doc_id", "base", added.alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and written spans of what find_secrets returns."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.size("added").cast("long").alias("n_random"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
    )
