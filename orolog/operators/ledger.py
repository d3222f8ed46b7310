"""Keyed merge of run results into a report, and what is left to do.

Employees are ``(seq, employee, employee_id)`` and items ``(seq, section, pos, file_id, item)``: seq is the place of
the employee in its list, pos the place of the item in its section, and item a struct of everything that is known
about the file. Everything is equi-joins and hash aggregation; order is kept as columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orolog.functions import exprs as X

SECTIONS = ("included", "skipped", "excluded_folders")


def keyed(employees: DataFrame) -> DataFrame:
    """With the employee's key and the name that is shown."""
    return employees.withColumn("key", X.person_key(F.col("employee_id"), F.col("employee"))).withColumn("employee", X.person_name(F.col("employee")))


def base_employees(manifest: DataFrame) -> DataFrame:
    """One row for each key: values of its last occurrence, place of its first. ``key, place, from_seq, employee, employee_id``."""
    last = lambda c: F.max_by(c, "seq").alias(c)
    return keyed(manifest).groupBy("key").agg(F.min("seq").alias("place"), F.max("seq").alias("from_seq"), last("employee"), last("employee_id"))


def name_index(base: DataFrame) -> DataFrame:
    """Key by normal name; of equal names the last stands. ``name, named_key``."""
    return base.groupBy(X.normal_name(F.col("employee")).alias("name")).agg(F.max_by("key", "place").alias("named_key"))


def resolve(report: DataFrame, base: DataFrame) -> DataFrame:
    """The key under which each employee of a report is filed, as ``target``; ``fresh`` if it is none of the base's.

    Its own key if the base has it, else that of the base employee of the same name, else its own, which from then
    on exists: later employees with this key go there whatever their names.
    """
    own = keyed(report).withColumn("name", X.normal_name(F.col("employee")))
    found = own.join(base.select("key", F.lit(True).alias("in_base")), "key", "left").join(name_index(base), "name", "left")
    opened = F.min(F.when(F.col("in_base").isNull() & F.col("named_key").isNull(), F.col("seq"))).over(Window.partitionBy("key"))
    found = found.withColumn("opened", opened)
    stays = F.col("in_base").isNotNull() | F.col("named_key").isNull() | (F.col("seq") > F.col("opened"))
    return found.withColumn("target", F.when(F.coalesce(stays, F.lit(False)), F.col("key")).otherwise(F.col("named_key"))).withColumn("fresh", F.col("in_base").isNull() & (F.col("target") == F.col("key")))


def upsert(items: DataFrame) -> DataFrame:
    """Fold items ``key, section, order, occurrence, file_id, item`` in their order.

    An item without id always stays. Of items with one id the first gives the place and the last everything
    else; copies that the base brought along beyond the first (occurrence above 1) stay as they are.
    """
    alone = X.blank_to_null(F.col("file_id")).isNull()
    one = F.when(alone, F.concat(F.lit("#"), F.to_json(F.struct("order")))).otherwise(F.concat(F.lit("="), F.col("file_id")))
    return items.withColumn("one", one).groupBy("key", "section", "one", F.coalesce("occurrence", F.lit(1)).alias("occurrence")).agg(F.min("order").alias("order"), F.max_by("item", "order").alias("item")).select("key", "section", "order", "item")


def _order(step: int, seq: Column, pos: Column) -> Column:
    return F.struct(F.lit(step).alias("step"), seq.cast("long").alias("seq"), pos.cast("long").alias("pos"))


def merge(manifest: DataFrame, manifest_items: DataFrame, report: DataFrame, report_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge a report into a manifest: employees ``key, place, employee, employee_id`` and folded items.

    Of the manifest, skipped files and excluded folders are results; included files are only candidates. Only the
    last occurrence of a key brings items. An employee that the report opens brings its excluded folders.
    """
    base = base_employees(manifest)
    owned = base.select("key", F.col("from_seq").alias("seq")).join(manifest_items.where("section <> 'included'"), "seq")
    twin = Window.partitionBy("key", "section", "file_id").orderBy("pos")
    old = owned.select("key", "section", _order(0, F.col("seq"), F.col("pos")).alias("order"), F.row_number().over(twin).alias("occurrence"), "file_id", "item")
    filed = resolve(report, base)
    opened = filed.where("fresh").groupBy("target").agg(F.min("seq").alias("place"), F.min_by("employee", "seq").alias("employee"), F.min_by("employee_id", "seq").alias("employee_id"))
    brought = filed.select("seq", F.col("target").alias("key")).join(report_items, "seq")
    first = opened.select(F.col("target").alias("key"), F.col("place").alias("seq"))
    folders = brought.where("section = 'excluded_folders'").join(first, ["key", "seq"], "left_semi")
    new = brought.where("section <> 'excluded_folders'").unionByName(folders)
    new = new.select("key", "section", _order(1, F.col("seq"), F.col("pos")).alias("order"), F.lit(1).alias("occurrence"), "file_id", "item")
    plain = old.where("section = 'excluded_folders'").unionByName(new.where("section = 'excluded_folders'")).select("key", "section", "order", "item")
    folded = upsert(old.where("section = 'skipped'").unionByName(new.where("section <> 'excluded_folders'")))
    employees = base.select("key", F.struct(F.lit(0).alias("step"), F.col("place").cast("long").alias("seq")).alias("place"), "employee", "employee_id")
    more = opened.select(F.col("target").alias("key"), F.struct(F.lit(1).alias("step"), F.col("place").cast("long").alias("seq")).alias("place"), "employee", "employee_id")
    return employees.unionByName(more), folded.unionByName(plain)


def legacy_report(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A flat list ``pos, status, employee, file_id, item`` as employees and items of the newer form.

    Each file names its employee, who has no id; success goes to included, all else to skipped.
    """
    named = files.withColumn("employee", X.person_name(F.col("employee")))
    employees = named.select(F.col("pos").alias("seq"), "employee", F.lit(None).cast("string").alias("employee_id"))
    items = named.select(F.col("pos").alias("seq"), F.when(F.col("status") == "success", "included").otherwise("skipped").alias("section"), F.lit(0).alias("pos"), "file_id", "item")
    return employees, items


def done_ids(items: DataFrame) -> DataFrame:
    """Ids of all files that have a result, failures included."""
    return items.where("section in ('included', 'skipped')").select(F.col("item.file_id").alias("file_id")).where("file_id <> ''").distinct()


def to_do(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Candidates without a result. Those without an id are never done; repeated ones stay repeated."""
    known = done.select(F.col("file_id").alias("__done"))
    return candidates.join(known, (F.col("file_id") == F.col("__done")) & (F.col("file_id") != ""), "left_anti")


def counts(employees: DataFrame, items: DataFrame) -> DataFrame:
    """Employees in report order with the number of items in each section."""
    n = lambda s, name: F.count_if(F.col("section") == s).alias(name)
    per = items.groupBy("key").agg(n("included", "included"), n("skipped", "skipped_files"), n("excluded_folders", "excluded_folders"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return employees.join(per, "key", "left").select("key", "place", "employee", "employee_id", zero("included"), zero("skipped_files"), zero("excluded_folders"))


def nested(employees: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each employee with the three lists in order: the shape of reports and manifests."""
    lists = items.groupBy("key").agg(*(F.array_sort(F.collect_list(F.when(F.col("section") == s, F.struct("order", "item")))).alias(s) for s in SECTIONS))
    plain = lambda s: F.coalesce(F.transform(s, lambda x: x["item"]), F.array())
    joined = counts(employees, items).withColumnsRenamed({"included": "n_included", "excluded_folders": "n_excluded"}).join(lists, "key", "left")
    return joined.select(
        "place",
        "employee",
        "employee_id",
        F.struct(F.col("n_included").alias("included"), F.col("skipped_files"), F.col("n_excluded").alias("excluded_folders")).alias("counts"),
        *(plain(s).alias(s) for s in SECTIONS),
    )


def outcome(parsed: DataFrame, documents: DataFrame, out_dir: str) -> DataFrame:
    """Result items of a run: ``employee, employee_id, file_id, file_name, status, reason, outputs``.

    `documents` are ``doc_id, employee, employee_id, file_id, file_name`` and, where a file may be unreadable, why in
    ``unread``; one without a file id fails without being read, and is filed under its employee's own key.
    """
    name = X.shown_name(F.col("file_name"), F.col("file_id"))
    folder = F.concat_ws("/", F.lit(out_dir), X.safe_name(X.person_name(F.col("employee"))), X.file_tag(name, F.col("file_id")))
    path = lambda f: F.concat(folder, F.lit(f"/{f}"))
    missing = X.blank_to_null(F.col("file_id")).isNull()
    unread = F.col("unread") if "unread" in documents.columns else F.lit(None).cast("string")
    joined = documents.join(parsed.select("doc_id", "status", "error"), "doc_id", "left")
    status = F.when(missing | F.coalesce(F.col("status") != "success", F.lit(True)), "failed").otherwise("success")
    reason = F.when(missing, "missing file_id").otherwise(F.coalesce(unread, F.col("error"), F.when(F.col("status").isNull(), "not read")))
    outputs = F.struct(path("days.csv").alias("days_csv"), path("pairs.csv").alias("pairs_csv"), path("totals.json").alias("totals_json"), path("report.json").alias("report_json"))
    return joined.select("doc_id", "employee", "employee_id", "file_id", name.alias("file_name"), status.alias("status"), F.when(status == "failed", reason).alias("reason"), F.when(status == "success", outputs).alias("outputs"))
