"""Scalar rules as Column expressions. All of them run inside the JVM and give null for null."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode text knows it, for use inside a character class.
SPACES = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Characters that words are made of, for use inside a character class.
WORDLY = r"\p{L}\p{N}_"

LINE_BREAK = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029]"
NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"

# Month names of the form's header, January first.
MONTHS = "GENNAIO FEBBRAIO MARZO APRILE MAGGIO GIUGNO LUGLIO AGOSTO SETTEMBRE OTTOBRE NOVEMBRE DICEMBRE".split()
# Weekdays of the form, Monday first.
WEEKDAYS = "LU MA ME GI VE SA DO".split()
# The printed totals and their keys.
TOTALS = {
    "ore_lavorate": "ORE LAVORATE",
    "ore_dovute_programmate": "ORE DOVUTE PROGRAMMATE",
    "ore_dovute_contrattuali": "ORE DOVUTE CONTRATTUALI",
    "dbcr_lordo_confermato": "DB/CR LORDO CONFERMATO",
    "dbcr_netto": "DB/CR NETTO",
    "saldo_al_mese_precedente": "SALDO AL MESE PRECEDENTE",
    "saldo_al_mese_corrente": "SALDO AL MESE CORRENTE",
}
# Shifts by their middle, in minutes of the day.
SHIFTS = {"Mattina": 480, "Pomeriggio": 840, "Notte": 1200}

# Patterns of the form's day lines, clock events and header lines.
DAY_HEAD = rf"^(0[1-9]|[12][0-9]|3[01])[{SPACES}]+({'|'.join(WEEKDAYS)})(?![{WORDLY}])"
EVENT = rf"(?<![{WORDLY}])([EU])[{SPACES}]*\(?([0-9]{{2}}:[0-9]{{2}})\)?"
HEADER = rf"RIEPILOGO PRESENZE/ASSENZE[{SPACES}]*-[{SPACES}]*([A-Z]+)[{SPACES}]+([0-9]{{4}})"
EMPLOYEE = rf"(?md)^([A-Z' ]+?)[{SPACES}]*-[{SPACES}]*([0-9]{{4,}})"


def running(values: Column, first: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array under an associative `join` whose neutral element is `first`.

    Step k joins each element with the one 2**k places before it: n log n in all, where a fold that appends to its
    result copies it for every element. `values` is worked out once.
    """

    def step(done: Column, gap: Column) -> Column:
        shifted = F.concat(F.array_repeat(first, gap), F.slice(done, 1, F.size(done) - gap))
        return F.when(F.size(done) > gap, F.zip_with(shifted, done, join)).otherwise(done)

    return F.aggregate(F.split(F.lit(",".join(str(1 << k) for k in range(31))), ",").cast("array<int>"), values, step)


def before(values: Column, first: Column) -> Column:
    """Each element's predecessor, the first one's being `first`."""
    return F.slice(F.concat(F.array(first), values), 1, F.size(values))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def first_text(*choices: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*map(blank_to_null, choices))


def strip(x: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(x, rf"^[{SPACES}]+|[{SPACES}]+$", "")


def pieces(x: Column) -> Column:
    """Stretches between white space, none of them empty."""
    return F.filter(F.split(x, rf"[{SPACES}]+"), lambda t: t != "")


def squeezed(x: Column) -> Column:
    """Single spaces between pieces, none at the ends."""
    return F.array_join(pieces(x), " ")


def extracted(x: Column, pattern: str, group: int) -> Column:
    """A group of the first match; null where there is no match or the group is empty."""
    return blank_to_null(F.regexp_extract(x, pattern, group))


def whole_lines(parts: Column) -> Column:
    """Parts between line breaks as lines: a break at the very end opens no further line."""
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def lines(text: Column) -> Column:
    """Lines of a text at any line break."""
    return whole_lines(F.split(text, LINE_BREAK))


def numeric_tokens(text: Column) -> Column:
    """Pieces that are plain signed decimals; anything with a colon is a time and no number."""
    return F.filter(pieces(text), lambda t: t.rlike(NUMBER) & ~t.contains(":"))


def number(token: Column) -> Column:
    return token.try_cast("double")


def hhmm_minutes(value: Column) -> Column:
    """Whole signed minutes of a number whose decimals are minutes (7.50: 7 hours 50); 60 minutes and more count on."""
    whole = F.floor(F.abs(value))
    return (F.signum(value) * (whole * 60 + F.rint((F.abs(value) - whole) * 100))).cast("long")


def hhmm_hours(value: Column) -> Column:
    """Decimal hours of a number whose decimals are minutes."""
    whole = F.floor(F.abs(value))
    hours = whole + F.rint((F.abs(value) - whole) * 100) / 60
    return F.when(value == 0, 0.0).when(value < 0, -hours).otherwise(hours).cast("double")


def month_number(name: Column) -> Column:
    table = F.create_map(*(F.lit(v) for n, m in enumerate(MONTHS, 1) for v in (m, n)))
    return F.try_element_at(table, name)


def header_month(text: Column) -> Column:
    return extracted(text, HEADER, 1)


def header_year(text: Column) -> Column:
    return extracted(text, HEADER, 2).cast("int")


def employee_name(text: Column) -> Column:
    return F.when(F.regexp_like(text, F.lit(EMPLOYEE)), strip(F.regexp_extract(text, EMPLOYEE, 1)))


def employee_number(text: Column) -> Column:
    return extracted(text, EMPLOYEE, 2)


def header(text: Column) -> Column:
    """The header's fields as a struct; three of them are never filled."""
    none = F.lit(None).cast("string")
    name = header_month(text)
    return F.struct(
        employee_name(text).alias("employee_name"),
        employee_number(text).alias("employee_id"),
        name.alias("month_name"),
        month_number(name).alias("month"),
        header_year(text).alias("year"),
        none.alias("unit"),
        none.alias("turno"),
        none.alias("qualifica"),
    )


def printed_total(text: Column, label: str) -> Column:
    """The number after a label's first occurrence that has one, as printed; empty where there is none."""
    return F.regexp_extract(text, label + rf"[{SPACES}]+([+-]?[0-9]+(?:\.[0-9]+)?)", 1)


def totals(text: Column) -> Column:
    """Map of the printed totals in decimal hours; a label that isn't found has no key.

    Each label is looked for once; what is worked out from its number goes through array elements.
    """
    printed = F.array(*(F.struct(F.lit(k).alias("key"), printed_total(text, label).alias("value")) for k, label in TOTALS.items()))
    found = F.filter(printed, lambda e: e["value"] != "")
    numbers = F.transform(found, lambda e: e.withField("value", number(e["value"])))
    return F.map_from_entries(F.transform(numbers, lambda e: e.withField("value", hhmm_hours(e["value"]))))


def event_tokens(line: Column) -> Column:
    """Clock events of a line in order, as structs (kind, time)."""
    part = lambda k, name: F.regexp_extract_all(line, F.lit(EVENT), F.lit(k)).alias(name)
    return F.arrays_zip(part(1, "kind"), part(2, "time"))


def clock_minutes(time: Column) -> Column:
    """Minutes of HH:MM from 00:00 to 23:59, and 1440 for 24:00; null for anything else."""
    h, m = F.substring(time, 1, 2).try_cast("int"), F.substring(time, 4, 2).try_cast("int")
    return F.when((h < 24) & (m < 60), h * 60 + m).when((h == 24) & (m == 0), 1440)


def moment(year: Column, month: Column, day: Column, time: Column) -> Column:
    """The time on that day (24:00: the next midnight); null where a part is missing or there is no such day or time."""
    start = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    return F.timestamp_add("MINUTE", clock_minutes(time), start)


def bad_moment(year: Column, month: Column, day: Column, time: Column) -> Column:
    """True where year, month and time are known but make no moment."""
    known = year.isNotNull() & month.isNotNull() & time.isNotNull()
    return known & moment(year, month, day, time).isNull()


def rolled_over(entry: Column, exit_: Column) -> Column:
    """An exit before its entry belongs to the next day."""
    return F.when(exit_ < entry, exit_ + F.expr("interval 1 day")).otherwise(exit_)


def minutes_between(entry: Column, exit_: Column) -> Column:
    return F.timestamp_diff("MINUTE", entry, exit_)


def hhmm_text(minutes: Column) -> Column:
    """HH:MM of whole minutes."""
    return F.when(minutes.isNotNull(), F.format_string("%02d:%02d", F.floor(minutes / 60), F.pmod(minutes, F.lit(60))))


def shift(entry: Column) -> Column:
    """The shift whose middle is nearest on the day's line (not circle); the earlier one on a tie."""
    m = F.hour(entry) * 60 + F.minute(entry)
    names, middles = list(SHIFTS), list(SHIFTS.values())
    out = F.when(m.isNotNull(), F.lit(names[-1]))
    for k in reversed(range(len(names) - 1)):
        out = F.when(m <= (middles[k] + middles[k + 1]) // 2, F.lit(names[k])).otherwise(out)
    return out


def normal_term(x: Column) -> Column:
    """Lower case, underscores and hyphens as spaces, single spaces."""
    return squeezed(F.translate(F.lower(x), "_-", "  "))


def normal_name(x: Column) -> Column:
    """Lower case and single spaces; null and empty are 'unknown', and white space alone is empty."""
    return F.when(blank_to_null(x).isNull(), F.lit("unknown")).otherwise(squeezed(F.lower(x)))


def person_key(person_id: Column, name: Column) -> Column:
    """id:… where there is an id, else name:… of the normal name."""
    return F.coalesce(F.concat(F.lit("id:"), blank_to_null(person_id)), F.concat(F.lit("name:"), normal_name(name)))


def person_name(*names: Column) -> Column:
    return F.coalesce(first_text(*names), F.lit("unknown"))


def safe_name(x: Column, most: int = 120) -> Column:
    """Usable as a file name: characters that paths give a meaning become _, at most so many characters stay."""
    kept = F.substring(F.translate(strip(x), '\\/:*?"<>|', "_" * 9), 1, most)
    return F.coalesce(blank_to_null(kept), F.lit("unnamed"))


def pdf_name(x: Column) -> Column:
    return F.when(F.lower(x).endswith(".pdf"), x).otherwise(F.concat(x, F.lit(".pdf")))


def file_tag(file_name: Column, file_id: Column) -> Column:
    """Folder of a file's outputs: its stem and the start of its id."""
    stem = F.regexp_replace(pdf_name(safe_name(file_name)), r"(?<=[^.])\.[^.]*$", "")
    return F.concat(stem, F.lit("__"), F.substring(file_id, 1, 8))


def shown_name(file_name: Column, file_id: Column) -> Column:
    return F.coalesce(first_text(file_name, file_id), F.lit("unknown.pdf"))


def first_term(name: Column, terms: list[str]) -> Column:
    """The first of the terms, in their order, that occurs in the lower-cased name; null if none does."""
    low = F.lower(name)
    return reduce(lambda rest, t: F.when(low.contains(t), F.lit(t)).otherwise(rest), reversed(terms), F.lit(None).cast("string"))


def utc_stamp() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
