"""Timesheet texts made from the event log, for queries and benchmarks.

One document for each user and month, one line for each day with an event: clicks and signups are entries, views
and purchases exits, errors nothing. Some exits are written as 24:00; some documents lack the total, carry a wrong
one, or have no day lines at all. The rules are plain enough to be computed from the events directly, which is
what the SQL of the queries does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolog.functions.exprs import MONTHS, WEEKDAYS

NO_DAYS_EVERY, NO_TOTAL_EVERY, WRONG_TOTAL_EVERY, MIDNIGHT_EVERY = 11, 7, 5, 17


def _hhmm(minutes: Column) -> Column:
    return F.format_string("%d.%02d", F.floor(minutes / 60), F.pmod(minutes, F.lit(60)))


def document_id(user: Column, at: Column) -> Column:
    return F.concat_ws("-", user.cast("string"), F.date_format(at, "yyyyMM"))


def timesheets(events: DataFrame) -> DataFrame:
    """``doc_id, user_id, text``."""
    day = F.to_date("ts")
    kind = F.when(F.col("event_type").isin("click", "signup"), "E").when(F.col("event_type").isin("view", "purchase"), "U")
    token = F.when((kind == "U") & (F.col("event_id") % MIDNIGHT_EVERY == 0), "U(24:00)").otherwise(F.concat(kind, F.lit(" "), F.date_format("ts", "HH:mm")))
    minute = F.hour("ts") * 60 + F.minute("ts")
    e = events.select("user_id", day.alias("day"), "event_id", F.when(kind.isNotNull(), F.struct(minute.alias("minute"), F.col("event_id").alias("e"), token.alias("token"))).alias("event"))
    daily = e.groupBy("user_id", "day").agg(F.array_sort(F.collect_list("event")).alias("events"), F.sum("event_id").alias("s"), F.count("*").alias("n"))
    number = F.date_format("day", "dd")
    clock = F.array_join(F.transform("events", lambda x: x["token"]), " ")
    worked = F.pmod("s", F.lit(600))
    line = F.concat(number, F.lit(" "), F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday("day") + 1), F.lit(" "), clock, F.lit(" | |"), number, F.lit(" LIB600 "), _hhmm(F.pmod(F.col("n") * 7, F.lit(500))), F.lit(" 6.00 "), _hhmm(worked))
    lines = daily.select("user_id", "day", document_id(F.col("user_id"), F.col("day")).alias("doc_id"), F.when(F.col("user_id") % NO_DAYS_EVERY != 0, line).alias("line"), worked.alias("worked"))
    docs = lines.groupBy("doc_id", "user_id").agg(F.min("day").alias("first"), F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("day", "line")))).alias("lines"), F.sum("worked").alias("worked"))
    user = F.col("user_id")
    total = F.col("worked") + F.when(user % WRONG_TOTAL_EVERY == 0, 30).otherwise(0)
    net = total - 2400
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month("first"))
    name = F.translate(F.concat(F.lit("USER "), user.cast("string")), "0123456789", "ABCDEFGHIJ")
    parts = F.array(
        F.concat(F.lit("RIEPILOGO PRESENZE/ASSENZE - "), month, F.lit(" "), F.year("first").cast("string"), F.lit(" Pag. 1")),
        F.concat(name, F.lit(" - "), (user + 10000).cast("string"), F.lit(" Un. Org. X")),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n"),
        F.when(user % NO_TOTAL_EVERY != 0, F.concat(F.lit("| ORE LAVORATE "), _hhmm(total))),
        F.lit("| ORE DOVUTE CONTRATTUALI 40.00"),
        F.concat(F.lit("| DB/CR NETTO "), F.when(net < 0, "-").otherwise("+"), _hhmm(F.abs(net))),
    )
    return docs.select("doc_id", "user_id", F.array_join(parts, "\n").alias("text"))
