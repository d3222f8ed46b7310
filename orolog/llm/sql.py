"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

#: CRC-32 by its bitwise definition (reflected polynomial 0xEDB88320) over a generated table of 256 entries.
_CRC = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
)"""

SHARDING = f"""
WITH {_CRC},
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
s AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total,
  row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS rank FROM d),
p AS (SELECT *, least(15, ((2 * before + size) * 16) // (2 * total)) AS shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  (rank - min(rank) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM p"""


_FOLD = "string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ')"

DECONTAMINATION = f"""
WITH b AS (SELECT item_id::VARCHAR AS item, list_filter({_FOLD}, lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS win FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS row, doc_id, list_filter({_FOLD}, lambda x: x <> '') AS w FROM documents),
widths AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT row, i, n, list_slice(w, i, i + n - 1) AS win FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n)),
hit AS (SELECT dw.row, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win),
hw AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS j FROM hit) GROUP BY row),
hi AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (row) LEFT JOIN hi USING (row)"""


def _spans(kinds: list[tuple[str, str, int, str]], order: str) -> str:
    """Counts and digest of the matches of patterns (kind, pattern, group of the value, which are good), with offsets in code points from running sums."""
    found = " UNION ALL ".join(
        f"""SELECT row, {place} AS k, '{kind}' AS n, unnest(m) AS m, unnest(v) AS v, unnest(list_slice(g, 1, len(m))) AS g, unnest(range(len(m))) AS i
  FROM (SELECT row, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, string_split_regex(t, '{pattern}') AS g FROM d)"""
        for place, (kind, pattern, group, _) in enumerate(kinds)
    )
    good = " OR ".join(f"(k = {place} AND ({test}))" for place, (*_, test) in enumerate(kinds))
    counted = ", ".join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind, *_ in kinds)
    counts = ", ".join(f"count(*) FILTER (k = {place}) AS n_{kind}" for place, (kind, *_) in enumerate(kinds))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
p AS (SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY row, k ORDER BY i))::BIGINT AS e FROM f),
a AS (SELECT row, {counts}, string_agg(concat(n, ':', e - length(m), ':', e), ',' ORDER BY {order}) AS spans FROM p WHERE {good} GROUP BY row)
SELECT doc_id, {counted}, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN a USING (row)"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT ELSE x::INT * 2 - 9 * (x::INT > 4)::INT END)) % 10 = 0"

SECRETS = _spans(
    [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, "length(v) >= 6"),
        ("access", "AKIA[A-Z0-9]+", 0, "length(m) >= 20"),
        ("hex", "[0-9a-f]+", 0, "length(m) >= 24"),
    ],
    "e - length(m), k",
)

PERSONAL = _spans(
    [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, "true"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0, "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR right(p, 4)::INT > 255)) = 0"),
        ("card", r"[0-9]([\x20-]?[0-9])+", 0, f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0, f"length({_DIGITS}) BETWEEN 9 AND 15"),
    ],
    "k, e - length(m)",
)

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT row, i, list_slice(words, i, i + 4) AS five FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT row, i, count(*) OVER (PARTITION BY row, five) AS n FROM win),
rep AS (SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS j FROM twice WHERE n > 1) GROUP BY row),
c AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
FROM w LEFT JOIN rep USING (row))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c"""

#: Sources are capped in order of size / weight: the last cap is the first place where what is left, shared by weight, fits under it.
TARGETS = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM s),
o AS (SELECT *, coalesce(sum(source_size) OVER before, 0) AS words_before, coalesce(sum(weight) OVER before, 0) AS weight_before, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
  FROM n WINDOW before AS (ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT *, (words - 3 * words_before)::DOUBLE / (weights - weight_before)::DOUBLE AS unit FROM o),
first AS (SELECT unit FROM u WHERE unit * weight <= 3 * source_size ORDER BY source_size / weight, no LIMIT 1),
t AS (SELECT source, source_size, least(weight * coalesce((SELECT unit FROM first), 0), (3 * source_size)::DOUBLE) AS target FROM n)
SELECT doc_id, size, source_size, target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source"""
