"""Timesheet documents to days, clock pairs, totals, header and validation.

A document is one row, so everything about it is worked out within the row, over the array of its lines: no
exchange, no sort, and no state between rows. The tables are explosions of those arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from orolog.functions import exprs as X

#: Hours by which the sum of the days may differ from the printed total.
TOLERANCE = 0.05
FEW_NUMBERS = 3

#: What stands above the first day head.
NO_HEAD_SQL = "named_struct('day', cast(null as int), 'dow', cast(null as string))"

NO_DAYS = "no day lines found"
BAD_TIME = "impossible time or date on a clock event"


def marked_lines(lines: Column) -> Column:
    """Lines with the day and weekday that they begin with, if they do."""
    stripped = F.transform(lines, lambda x, i: F.struct(i.alias("line_no"), x.alias("raw"), F.regexp_extract(X.strip(x), X.DAY_HEAD, 0).alias("head")))
    return F.transform(stripped, lambda x: x.withField("day", F.substring(x["head"], 1, 2).try_cast("int")).withField("dow", X.blank_to_null(F.right(x["head"], F.lit(2)))))


def days(marked: Column) -> Column:
    """Day records: lines that begin with a day and have three numbers after it, the last three of which are its hours.

    The head's length is counted on the stripped line but cut from the raw one.
    """
    found = F.filter(marked, lambda x: x["day"].isNotNull())
    read = F.transform(found, lambda x: x.withField("n", X.numeric_tokens(F.substring(x["raw"], F.length(x["head"]) + 1, F.length(x["raw"])))))
    full = F.filter(read, lambda x: F.size(x["n"]) >= FEW_NUMBERS)
    valued = F.transform(full, lambda x: x.withField("v", F.transform(F.slice(x["n"], -FEW_NUMBERS, FEW_NUMBERS), X.number)))
    return F.transform(
        valued,
        lambda x: F.struct(
            x["line_no"].alias("line_no"),
            x["day"].alias("day"),
            x["dow"].alias("dow"),
            X.hhmm_hours(x["v"][0]).alias("mo_f"),
            X.hhmm_hours(x["v"][1]).alias("mo_t"),
            X.hhmm_hours(x["v"][2]).alias("mo_lav"),
            X.hhmm_minutes(x["v"][2]).alias("worked"),
            x["raw"].alias("raw"),
        ),
    )


def told_lines(marked: Column) -> Column:
    """Lines that begin with a day or tell of events, with these."""
    told = F.transform(marked, lambda x: F.struct(x["day"].alias("day"), x["dow"].alias("dow"), X.event_tokens(x["raw"]).alias("tokens"), x["raw"].alias("raw")))
    return F.filter(told, lambda x: x["day"].isNotNull() | (F.size(x["tokens"]) > 0))


def heads(told: Column) -> Column:
    """For each line the day head that it stands under; null above the first."""
    return X.running(F.transform(told, lambda x: F.struct(x["day"].alias("day"), x["dow"].alias("dow"))), F.expr(NO_HEAD_SQL), lambda a, b: F.when(b["day"].isNull(), a).otherwise(b))


def runs(under: Column) -> Column:
    """For each line its run, from 1; 0 above the first head."""
    changed = F.zip_with(under, X.before(under, F.expr(NO_HEAD_SQL)), lambda now, last: F.when(now["day"].isNull() | (now["day"].eqNullSafe(last["day"]) & now["dow"].eqNullSafe(last["dow"])), 0).otherwise(1))
    return X.running(changed, F.lit(0), lambda a, b: a + b)


def events(told: Column, under: Column) -> Column:
    """Clock events in order, each with its run.

    A run begins at a day head whose day and weekday differ from those of the run before; a repeated head goes
    on with it. Lines before the first head belong to none, and their events are left out.
    """
    placed = F.zip_with(under, runs(under), lambda h, run: F.struct(run.alias("run"), h["day"].alias("day"), h["dow"].alias("dow")))
    lined = F.filter(F.zip_with(told, placed, lambda x, r: F.struct(r.alias("r"), x["tokens"].alias("tokens"), x["raw"].alias("raw"))), lambda x: x["r"]["run"] > 0)
    spread = lambda x: F.transform(x["tokens"], lambda t: F.struct(x["r"]["run"].alias("run"), x["r"]["day"].alias("day"), x["r"]["dow"].alias("dow"), t["kind"].alias("kind"), t["time"].alias("time"), x["raw"].alias("raw")))
    return F.flatten(F.transform(lined, spread))


def neighbours(found: Column) -> Column:
    """Events with the ones before and after them in their run."""
    none = F.array(F.get(found, F.lit(-1)))
    zipped = F.arrays_zip(found.alias("e"), F.concat(none, found).alias("p"), F.concat(F.slice(found, 2, F.size(found)), none).alias("n"))
    known = F.filter(zipped, lambda x: x["e"].isNotNull())
    return F.transform(known, lambda x: F.struct(x["e"].alias("e"), F.when(x["p"]["run"] == x["e"]["run"], x["p"]).alias("p"), F.when(x["n"]["run"] == x["e"]["run"], x["n"]).alias("n")))


def paired(near: Column) -> Column:
    """The events that a pair begins with: entries, and exits without one."""
    return F.filter(near, lambda x: (x["e"]["kind"] == "E") | x["p"].isNull() | (x["p"]["kind"] == "U"))


def pairs(kept: Column, year: Column, month: Column) -> Column:
    """Entries and exits of one run paired in order: an entry takes the exit that follows it, and either may stay alone."""
    sided = F.transform(kept, lambda x: F.struct(x["e"]["run"].alias("run"), x["e"]["day"].alias("day"), x["e"]["dow"].alias("dow"), F.when(x["e"]["kind"] == "E", x["e"]).alias("entry"), F.when(x["e"]["kind"] == "U", x["e"]).when(x["n"]["kind"] == "U", x["n"]).alias("exit")))
    timed = F.transform(
        sided,
        lambda x: F.struct(
            x["run"].alias("run"),
            x["day"].alias("day"),
            x["dow"].alias("dow"),
            X.moment(year, month, x["day"], x["entry"]["time"]).alias("entry_ts"),
            X.moment(year, month, x["day"], x["exit"]["time"]).alias("exit_ts"),
            x["entry"]["raw"].alias("entry_raw"),
            x["exit"]["raw"].alias("exit_raw"),
        ),
    )
    rolled = F.transform(timed, lambda x: x.withField("exit_ts", X.rolled_over(x["entry_ts"], x["exit_ts"])))
    lasting = F.transform(rolled, lambda x: x.withField("minutes", X.minutes_between(x["entry_ts"], x["exit_ts"]).cast("long")).withField("turno", X.shift(x["entry_ts"])))
    placed = F.transform(lasting, lambda x, i: x.withField("duration_hhmm", X.hhmm_text(x["minutes"])).withField("place", i))
    run = F.transform(kept, lambda x: x["e"]["run"])
    began = F.transform(F.arrays_zip(run.alias("now"), X.before(run, F.lit(0)).alias("last")), lambda x, i: F.when(x["now"] == x["last"], 0).otherwise(i))
    return F.zip_with(placed, X.running(began, F.lit(0), lambda a, b: F.greatest(a, b)), lambda x, at: x.withField("pair_index", x["place"] - at))


def validation(day_records: Column, printed: Column) -> Column:
    """The sum of the days against the printed total. Minutes are summed as whole numbers, so order doesn't matter."""
    row_sum = F.aggregate(day_records, F.lit(0).cast("long"), lambda s, d: s + F.coalesce(d["worked"], F.lit(0))) / 60
    diff = row_sum - printed
    return F.struct(
        row_sum.alias("ore_lavorate_row_sum"),
        printed.alias("ore_lavorate_total"),
        diff.alias("ore_lavorate_diff"),
        F.coalesce(F.abs(diff) < TOLERANCE, F.lit(False)).alias("is_ok"),
    )


def parse_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One nested row for each document: ``doc_id, status, error, meta, days, pairs, totals, validation``.

    A document without day lines, or with a clock event at an impossible time or date of a known month, fails as
    a whole: it has an error and empty tables, and other documents go on. A null text has no lines. Each step is a
    projection of its own, so that what a later one uses often is worked out once.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    read = read.select("doc_id", X.header(F.col("text")).alias("meta"), F.split("text", X.LINE_BREAK).alias("parts"), X.totals(F.col("text")).alias("found_totals"))
    read = read.select("doc_id", "meta", "found_totals", marked_lines(X.whole_lines(F.col("parts"))).alias("marked"))
    read = read.select("doc_id", "meta", "found_totals", days(F.col("marked")).alias("found_days"), told_lines(F.col("marked")).alias("told"))
    read = read.select("*", heads(F.col("told")).alias("under"))
    read = read.select("doc_id", "meta", "found_totals", "found_days", events(F.col("told"), F.col("under")).alias("events"))
    year, month = F.col("meta.year"), F.col("meta.month")
    bad = F.exists("events", lambda e: X.bad_moment(year, month, e["day"], e["time"]))
    error = F.when(F.size("found_days") == 0, NO_DAYS).when(bad, BAD_TIME)
    never = F.when(F.spark_partition_id() < 0, "")  # keeps filters on the error above this step; below it they would parse once more
    read = read.select("*", F.coalesce(error, never).alias("error"))
    fine = F.col("error").isNull()
    none = lambda c: F.when(fine, F.col(c)).otherwise(F.slice(c, 1, 0)).alias(c)
    read = read.select("doc_id", "error", "meta", F.when(fine, F.col("found_totals")).alias("totals"), none("found_days"), none("events"))
    read = read.select("doc_id", "error", "meta", "totals", "found_days", neighbours(F.col("events")).alias("near"))
    read = read.withColumn("near", paired(F.col("near")))
    checked = validation(F.col("found_days"), F.try_element_at("totals", F.lit("ore_lavorate")))
    return read.select(
        "doc_id",
        F.when(fine, "success").otherwise("failed").alias("status"),
        "error",
        "meta",
        F.col("found_days").alias("days"),
        pairs(F.col("near"), year, month).alias("pairs"),
        "totals",
        F.when(fine, checked).alias("validation"),
    )


class ParseError(ValueError):
    """A single document that can't be parsed."""


def parse_one(spark: SparkSession, text: str | None) -> Row:
    """The nested row of one document; where `parse_documents` gives an error this raises it."""
    row = parse_documents(spark.createDataFrame([("document", text)], "doc_id string, text string")).first()
    if row["error"] is not None:
        raise ParseError(row["error"])
    return row


def _each(parsed: DataFrame, records: str, name: str) -> DataFrame:
    """A row for each record. An outer explode: of a plain one the optimizer makes a filter that parses everything once more."""
    return parsed.select("doc_id", "meta.year", "meta.month", F.explode_outer(records).alias(name)).where(F.col(name).isNotNull())


def days_table(parsed: DataFrame) -> DataFrame:
    """``doc_id, line_no`` and the columns of the days table."""
    rows = _each(parsed, "days", "d")
    return rows.select("doc_id", "d.line_no", "year", "month", "d.day", "d.dow", "d.mo_f", "d.mo_t", "d.mo_lav", "d.raw")


def pairs_table(parsed: DataFrame) -> DataFrame:
    """``doc_id, run`` and the columns of the pairs table, with whole minutes beside the duration."""
    rows = _each(parsed, "pairs", "p")
    return rows.select("doc_id", "p.run", "year", "month", "p.day", "p.dow", "p.pair_index", "p.entry_ts", "p.exit_ts", "p.duration_hhmm", "p.minutes", "p.turno", "p.entry_raw", "p.exit_raw")


def totals_table(parsed: DataFrame) -> DataFrame:
    """``doc_id`` and a nullable column for each total."""
    return parsed.where("status = 'success'").select("doc_id", *(F.try_element_at("totals", F.lit(k)).alias(k) for k in X.TOTALS))


def validation_table(parsed: DataFrame) -> DataFrame:
    return parsed.where("status = 'success'").select("doc_id", "validation.*")


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no, line`` of every line; null and empty texts have none."""
    parts = docs.select(F.col(id_col).alias("doc_id"), F.split(F.col(text_col), X.LINE_BREAK).alias("parts"))
    return parts.select("doc_id", F.posexplode_outer(X.whole_lines(F.col("parts"))).alias("line_no", "line")).where("line is not null")


def segment_runs(df: DataFrame, by: list[str], order: list[str], value: list[str], name: str = "run_id") -> DataFrame:
    """Number the runs of equal values within each group of rows, from 1, in order (gaps and islands).

    For rows that are already apart, such as an event log. Both windows use one exchange and one sort.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    now = F.struct(*value)
    marked = df.withColumn("__changed", F.when(now.eqNullSafe(F.lag(now).over(w)), 0).otherwise(1))
    return marked.withColumn(name, F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__changed")


def pair_events(df: DataFrame, by: list[str], order: list[str], kind: str, time: str) -> DataFrame:
    """Pair entries ('E') and exits ('U') that are rows of their own, by the rules of `pairs`.

    Returns ``by, pair_index, entry_ts, exit_ts`` over one exchange and one sort.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    k, t = F.col(kind), F.col(time)
    seen = df.select(*by, *order, k.alias("__k"), t.alias("__t"), F.lag(k).over(w).alias("__before"), F.lead(k).over(w).alias("__after"), F.lead(t).over(w).alias("__next"))
    kept = seen.where("__k = 'E' or __before is null or __before = 'U'")
    entry = F.when(F.col("__k") == "E", F.col("__t"))
    exit_ = F.when(F.col("__k") == "U", F.col("__t")).when(F.col("__after") == "U", F.col("__next"))
    return kept.select(*by, (F.row_number().over(w) - 1).alias("pair_index"), entry.alias("entry_ts"), exit_.alias("exit_ts"))
