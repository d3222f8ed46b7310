"""The queries over the reference's operators and their SQL.

Timesheet queries write documents from the event log and parse them back; their SQL works on the events and never
sees a text, so the two have nothing in common but the rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolog.functions import exprs as X
from orolog.operators import ledger, listing
from orolog.operators import timesheet as S
from orolog.plans import oracle, synth

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed forms. They are few bytes but dear to parse, so they are dealt out by rows: exchanges coalesce by bytes."""
    docs = synth.timesheets(_table(spark, sf_dir, "events"))
    return S.parse_documents(docs.repartition(spark.sparkContext.defaultParallelism))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.pairs_table(_parsed(spark, sf_dir))


def hours_per_user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes between paired entries and exits of each document and day."""
    n = F.count("*").cast("long")
    return _pairs(spark, sf_dir).groupBy("doc_id", "day").agg(F.sum(F.coalesce("minutes", F.lit(0))).alias("minutes"), n.alias("n_pairs"), F.count("minutes").alias("n_closed"))


flagship = hours_per_user_day


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", "day", "pair_index", "entry_ts", "exit_ts")


def event_pairs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of all users, from events that are rows already."""
    e = _table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("click", "signup"), "E").when(F.col("event_type").isin("view", "purchase"), "U")
    day = F.to_date("ts")
    minute = F.timestamp_add("MINUTE", F.hour("ts") * 60 + F.minute("ts"), day.cast("timestamp_ntz"))
    e = e.select("user_id", day.alias("d"), minute.alias("m"), "event_id", kind.alias("kind")).where("kind is not null")
    time = F.when((F.col("kind") == "U") & (F.col("event_id") % synth.MIDNIGHT_EVERY == 0), F.timestamp_add("DAY", F.lit(1), F.col("d").cast("timestamp_ntz"))).otherwise(F.col("m"))
    got = S.pair_events(e.withColumn("t", time), ["user_id", "d"], ["m", "event_id"], "kind", "t")
    return got.select(synth.document_id(F.col("user_id"), F.col("d")).alias("doc_id"), F.dayofmonth("d").alias("day"), "pair_index", "entry_ts", "exit_ts")


def pair_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", "day", "pair_index", "duration_hhmm", "minutes")


def shift_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", "day", "pair_index", "turno")


def unmatched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).where("entry_ts is null or exit_ts is null").select("doc_id", "day", "pair_index", "entry_ts", "exit_ts")


def overnight_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exit at a time of day that may lie before the entry's."""
    e = _table(spark, sf_dir, "events")
    start = F.to_date("ts").cast("timestamp_ntz")
    entry = F.timestamp_add("MINUTE", F.hour("ts") * 60 + F.minute("ts"), start)
    exit_ = X.rolled_over(entry, F.timestamp_add("MINUTE", F.pmod(F.col("event_id") * 7, F.lit(1440)).cast("int"), start))
    return e.select("event_id", exit_.alias("exit_ts"), X.hhmm_text(X.minutes_between(entry, exit_)).alias("duration_hhmm"))


def day_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of equal event types of each user, in time order."""
    e = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return S.segment_runs(e, ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", F.col("run_id").cast("long").alias("run_id"))


def day_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.days_table(_parsed(spark, sf_dir))
    return d.select("doc_id", "year", "month", "day", "dow", *(F.round(c, 9).alias(c) for c in ("mo_f", "mo_t", "mo_lav")))


def numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.numeric_tokens(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.array_join(found, " ").alias("tokens"))


def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.line_table(_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.md5(F.col("line").cast("binary")).alias("line_md5"))


def hhmm_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("l_returnflag") == "R", -1).otherwise(1) * (F.col("l_quantity") + F.col("l_discount"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(X.hhmm_hours(v), 9).alias("hours"), X.hhmm_minutes(v).alias("minutes"))


def totals_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parsed(spark, sf_dir).where("status = 'success'").select("doc_id", F.explode_outer("totals").alias("label", "value")).where("label is not null")
    return rows.select("doc_id", "label", F.round("value", 9).alias("value"))


def totals_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.totals_table(_parsed(spark, sf_dir))
    return rows.select("doc_id", *(F.round(k, 9).alias(k) for k in X.TOTALS))


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.validation_table(_parsed(spark, sf_dir))
    return rows.select("doc_id", *(F.round(c, 6).alias(c) for c in rows.columns[1:4]), "is_ok")


def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).groupBy("status", "error").agg(F.count("*").alias("n"))


def month_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months written as a form's header and read back; a third of them misspelt."""
    o = _table(spark, sf_dir, "orders")
    name = F.element_at(F.array(*map(F.lit, X.MONTHS)), F.month("o_orderdate"))
    text = F.concat(F.lit("Pag. 1\nRIEPILOGO PRESENZE/ASSENZE - "), name, F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(""), F.lit("  "), F.year("o_orderdate").cast("string"))
    h = o.select(X.header(text).alias("h")).select("h.month_name", "h.month", "h.year")
    return h.groupBy("month_name", "month", "year").agg(F.count("*").alias("n"))


def employee_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    name = F.translate(F.upper("c_name"), "#0123456789", " ABCDEFGHIJ")
    name = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("É"), name)).otherwise(name)
    text = F.concat(F.lit("first line\n"), name, F.lit("  - "), (F.col("c_custkey") * 3).cast("string"), F.lit(" Un. Org."))
    return c.select("c_custkey", X.employee_name(text).alias("employee_name"), X.employee_number(text).alias("employee_id"))


def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of a form's header, those that are never filled included."""
    c = _table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    month = F.element_at(F.array(*map(F.lit, [*X.MONTHS, "MAGGIOX"])), (k % 13 + 1).cast("int"))
    name = F.translate(F.upper("c_name"), "#0123456789", " ABCDEFGHIJ")
    text = F.concat(F.lit("RIEPILOGO PRESENZE/ASSENZE -"), month, F.lit(" "), (2000 + k % 30).cast("string"), F.lit("\n"), name, F.lit(" - "), (k * 3).cast("string"))
    return c.select("c_custkey", X.header(text).alias("h")).select("c_custkey", "h.*")


def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with events above the first day, and day lines with too few numbers for a record, whose events count all the same."""
    k = F.col("c_custkey")
    early = F.when(k % 2 == 0, "E 05:00 U 05:30\n").otherwise("")
    numbers = F.array_join(F.slice(F.array(*(F.lit(f"{n}.00") for n in range(1, 5))), F.lit(1), (k % 5).cast("int")), " ")
    text = F.concat(early, F.lit("01 LU E 08:00 U 09:00 | "), numbers, F.lit("\n02 MA E 10:00 | 1.00 2.00 3.00\nU 11:00"))
    parsed = S.parse_documents(_table(spark, sf_dir, "customer").select(k.alias("doc_id"), text.alias("text")))
    days = F.array_join(F.transform("days", lambda d: d["day"].cast("string")), ",")
    pairs = F.array_join(F.transform("pairs", lambda p: F.concat_ws("/", p["day"].cast("string"), p["pair_index"].cast("string"))), ",")
    return parsed.select(F.col("doc_id").alias("c_custkey"), days.alias("days"), pairs.alias("pairs"), F.expr("coalesce(try_element_at(days, 1).mo_lav, 0)").alias("first_worked"))


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest that lists keys several times: the last occurrence gives the values, the first the place."""
    o = _table(spark, sf_dir, "orders")
    people = o.select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("N "), F.col("o_orderkey").cast("string")).alias("employee"), F.col("o_custkey").cast("string").alias("employee_id"))
    return ledger.base_employees(people)


def normalize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.concat(F.lit("  "), F.translate("url", "/", " ")).alias("x"))
    q = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), F.concat_ws("__", "p_type", "p_name").alias("x"))
    return p.unionByName(q).select("kind", "id", X.normal_term(F.col("x")).alias("term"), X.normal_name(F.col("x")).alias("name"))


FILE_TERMS = ["ring", "red", "small ring", "bolt"]


def file_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select("p_partkey", X.first_term(F.initcap("p_name"), FILE_TERMS).alias("reason"))


FOLDER_TERMS = ["asia", "nation 3", "nation 17"]


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and customers as a listing: folders below 'root', and files that are PDFs, archives or neither."""
    r, n, c = (_table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    no = F.lit(False)
    folder = F.lit(listing.FOLDER)
    key = lambda letter, col: F.concat(F.lit(letter), F.col(col).cast("string"))
    kind = F.col("c_custkey") % 4
    mime = F.when(kind == 0, listing.ZIPS[0]).when(kind == 1, "text/plain").otherwise(listing.PDF)
    name = F.concat("c_mktsegment", F.lit(" "), "c_name", F.when(F.col("c_custkey") % 13 == 0, " Propaganda").otherwise(""), F.when(kind == 1, ".Zip").otherwise(""))
    return (
        r.select(key("r", "r_regionkey").alias("id"), F.lit("root").alias("parent_id"), F.col("r_name").alias("name"), folder.alias("mime_type"), no.alias("trashed"))
        .unionByName(n.select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent_id"), F.col("n_name").alias("name"), folder.alias("mime_type"), no.alias("trashed")))
        .unionByName(c.select(key("c", "c_custkey").alias("id"), key("n", "c_nationkey").alias("parent_id"), name.alias("name"), mime.alias("mime_type"), (F.col("c_custkey") % 10 == 9).alias("trashed")))
    )


def tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tree(spark, sf_dir)
    folders, _ = listing.walk(t, listing.employee_roots(t, "root"), FOLDER_TERMS)
    return folders.select("employee_id", "folder_id", "level")


def folder_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tree(spark, sf_dir)
    _, gone = listing.walk(t, listing.employee_roots(t, "root"), FOLDER_TERMS)
    return gone.select("employee_id", "folder_id", "folder_name", "reason")


def scan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, items, _ = listing.scan(_tree(spark, sf_dir), "root", FOLDER_TERMS + ["paga"])
    return items.select("employee_id", "section", "file_id", "container", "reason")


def scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees, _, _ = listing.scan(_tree(spark, sf_dir), "root", FOLDER_TERMS + ["paga"])
    return employees


def file_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "pages")
    mime = F.when(F.col("url").endswith(".html"), listing.PDF).when(F.col("page_id") % 5 == 0, listing.ZIPS[1]).otherwise("text/html")
    name = F.when(F.col("page_id") % 7 == 0, F.concat("url", F.lit(".ZIP"))).otherwise(F.col("url"))
    return p.select("page_id", listing.container(name, mime).alias("kind")).where("kind is not null")


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", X.safe_name(F.repeat("url", F.lit(3))).alias("safe"), X.pdf_name(X.safe_name(F.col("url"))).alias("file"))


def file_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "pages")
    name = F.when(F.col("page_id") % 6 != 0, F.col("url"))
    file_id = F.md5(F.col("page_id").cast("string").cast("binary"))
    return p.select("page_id", X.shown_name(name, file_id).alias("shown"), X.file_tag(X.shown_name(name, file_id), file_id).alias("tag"))


def employee_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    pid = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey").cast("string")).otherwise(F.when(F.col("c_custkey") % 2 == 0, ""))
    name = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit(" "), F.col("c_name"), F.lit("  "), F.col("c_mktsegment")))
    return c.select("c_custkey", X.person_key(pid, name).alias("key"), X.person_name(name).alias("name"))


def _ledger_tables(spark: SparkSession, sf_dir: str, legacy: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers as a manifest's employees, orders as files.

    Open orders are files skipped by the manifest, filled and pending ones the report's included and skipped
    files; ids repeat. Every 7th customer has no id, and every 10th of the report an id that the manifest doesn't know.
    """
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    k = F.col("c_custkey")
    people = c.select(k.alias("seq"), F.col("c_name").alias("employee"), F.when(k % 7 != 0, k.cast("string")).alias("employee_id"))
    file_id = F.when(F.col("o_orderkey") % 50 != 0, (F.col("o_orderkey") % 40).cast("string"))
    files = o.select(F.col("o_custkey").alias("seq"), "o_orderstatus", F.col("o_orderkey").alias("pos"), file_id.alias("file_id"), F.struct(file_id.alias("file_id"), F.col("o_orderkey").cast("string").alias("file_name")).alias("item"))
    old = files.where("o_orderstatus = 'O'").select("seq", F.lit("skipped").alias("section"), "pos", "file_id", "item")
    rest = files.where("o_orderstatus <> 'O'")
    if legacy:
        named = rest.join(c.select(k.alias("seq"), F.concat(F.lit(" "), F.upper("c_name")).alias("employee")), "seq")
        status = F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed")
        return people, old, *ledger.legacy_report(named.select("pos", status.alias("status"), "employee", "file_id", "item"))
    theirs = c.select(k.alias("seq"), F.upper("c_name").alias("employee"), F.when(k % 10 == 0, F.concat(F.lit("x"), k.cast("string"))).when(k % 7 != 0, k.cast("string")).alias("employee_id"))
    theirs = theirs.withColumn("employee", F.when(F.col("seq") % 20 == 0, F.concat(F.lit("New "), "employee")).otherwise(F.col("employee")))
    new = rest.select("seq", F.when(F.col("o_orderstatus") == "F", "included").otherwise("skipped").alias("section"), "pos", "file_id", "item")
    return people, old, theirs, new


def _merged(spark: SparkSession, sf_dir: str, legacy: bool) -> tuple[DataFrame, DataFrame]:
    return ledger.merge(*_ledger_tables(spark, sf_dir, legacy))


def _item_rows(items: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("key", "section").orderBy("order"))
    return items.select("key", "section", place.cast("long").alias("place"), "item.file_id", "item.file_name")


def report_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_rows(_merged(spark, sf_dir, False)[1])


def legacy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_rows(_merged(spark, sf_dir, True)[1])


def finalize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger.counts(*_merged(spark, sf_dir, False))
    return rows.select("key", "employee", "employee_id", "included", "skipped_files", "excluded_folders")


def cached_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, some of them without an id, that have no result."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    file_id = lambda k: F.when(k % 50 == 0, "").when(k % 51 != 0, (k % 5000).cast("string"))
    items = o.where("o_orderstatus <> 'O'").select(F.when(F.col("o_orderstatus") == "F", "included").otherwise("skipped").alias("section"), F.struct(file_id(F.col("o_orderkey")).alias("file_id")).alias("item"))
    candidates = o.where("o_orderstatus = 'O'").select("o_orderkey", file_id(F.col("o_orderkey")).alias("file_id"))
    return ledger.to_do(candidates, ledger.done_ids(items.where("coalesce(try_cast(item.file_id as int) % 3 = 0, true)")))


def sorted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDFs of an index in path order, ranked within their host."""
    from pyspark.sql import Window

    p = _table(spark, sf_dir, "pages")
    path = F.when(F.col("page_id") % 8 != 0, F.col("url"))
    mime = F.when(F.col("page_id") % 3 != 0, listing.PDF).otherwise("text/html")
    host = F.split_part("url", F.lit("/"), F.lit(3))
    rows = listing.pdf_matches(p.select(F.col("page_id").alias("pos"), F.col("page_id").cast("string").alias("id"), F.lit("").alias("name"), path.alias("path"), mime.alias("mimeType"), host.alias("host")))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.lower(F.coalesce("path", F.lit(""))), "pos"))
    return rows.select("id", "shown", rank.cast("long").alias("place"))


def _json_rows(spark: SparkSession, sf_dir: str, legacy: bool) -> DataFrame:
    rows = ledger.nested(*_merged(spark, sf_dir, legacy))
    text = F.to_json(F.struct("employee", "employee_id", "counts", "included", "skipped"), {"ignoreNullFields": "false"})
    back = F.from_json(text, "employee string, employee_id string, counts struct<included: bigint, skipped_files: bigint>, included array<struct<file_id: string, file_name: string>>, skipped array<struct<file_id: string, file_name: string>>")
    names = lambda s: F.md5(F.array_join(F.transform(F.col(f"b.{s}"), lambda x: x["file_name"]), ",").cast("binary"))
    return rows.select(back.alias("b")).select("b.employee", "b.employee_id", F.col("b.counts.included").alias("n_included"), F.col("b.counts.skipped_files").alias("n_skipped"), names("included").alias("included_md5"), names("skipped").alias("skipped_md5"))


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged reports written as JSON and read back."""
    return _json_rows(spark, sf_dir, False)


def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_rows(spark, sf_dir, True)


_ALL: tuple[Query, ...] = (
    hours_per_user_day, event_pairs, event_pairs_rows, pair_durations, shift_label, unmatched_events, overnight_rollover, day_runs, day_lines, numeric_tokens,
    line_scan, hhmm_decimal, totals_map, totals_wide, validation, status_summary, month_lookup, employee_header, header_fields, odd_lines, repeated_keys, normalize_terms, file_exclusion,
    tree_walk, folder_exclusion, scan_items, scan_counts, file_type_filter, safe_names, file_tags, employee_keys, report_merge, legacy_merge,
    finalize_counts, cached_anti_join, sorted_index, report_json, manifest_json,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
