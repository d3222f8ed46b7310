"""Command line: parse documents, list a folder tree into a manifest, run a manifest."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolog.operators import ledger, listing, timesheet
from orolog.session import local_session
from orolog.sinks import files as sinks
from orolog.sources import documents, folder_tree, reports

LOG = logging.getLogger("orolog")
#: Files after which a run writes its report.
BATCH = 1000


def texts_of(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text, error`` of one file (a PDF unless it ends in .txt), or of the PDFs and texts in a folder and below it.

    The path may be in any file system that Spark reads. A file that can't be read has a null text and says why.
    """
    none = F.lit(None).cast("string")
    plain = lambda glob: documents.text_files(spark, path, glob).withColumn("error", none)
    if path.lower().endswith(".txt"):
        return plain("*")
    pdfs = documents.pdf_texts(documents.pdf_files(spark, path))
    if not documents.is_folder(spark, path):
        return pdfs
    parts = [rows for glob, rows in (("*.pdf", pdfs), ("*.txt", None)) if documents.any_file(spark, path, glob) for rows in [plain(glob) if rows is None else rows]]
    if not parts:
        raise SystemExit(f"no documents in {path}")
    return reduce(DataFrame.unionByName, parts)


def parse(spark: SparkSession, source: str, out: str) -> int:
    """Write each document's four files to `out`; the number of documents that failed."""
    texts = texts_of(spark, source).persist()
    parsed = timesheet.parse_documents(texts).persist()
    os.makedirs(out, exist_ok=True)
    sinks.write_documents(parsed, F.lit(os.path.abspath(out)), documents.safe_stem(F.col("doc_id"))).count()
    why = texts.select("doc_id", F.col("error").alias("unread"))
    shown = parsed.select("doc_id", "error", sinks.totals_json(parsed).alias("totals")).join(why, "doc_id")
    for r in shown.orderBy("doc_id").toLocalIterator():
        print(r["totals"] if r["error"] is None else f"{r['doc_id']}: {r['unread'] or r['error']}")
    failed = parsed.where("status = 'failed'").count()
    parsed.unpersist()
    texts.unpersist()
    return failed


def listing_table(spark: SparkSession, path: str) -> DataFrame:
    """A listing from Parquet, from JSON lines, or of a folder tree."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(folder_tree.SCHEMA).json(path)
    folder_tree.register(spark)
    return spark.read.format("folder_listing").load(os.path.abspath(path))


def catalog_scan(spark: SparkSession, table: DataFrame, root: str, out: str, terms: list[str] | None = None) -> str:
    """Write the manifest of a listing; its path."""
    held: list[DataFrame] = []
    employees, items, folders = listing.scan(table, root, listing.TERMS if terms is None else terms, held)
    none = F.lit(None).cast("string")
    item = F.struct("file_id", "file_name", "mimeType", "container", "reason", F.lit(None).cast(reports.OUTPUTS).alias("outputs"), none.alias("folder_id"), none.alias("folder_name"))
    gone = F.struct(none.alias("file_id"), none.alias("file_name"), none.alias("mimeType"), none.alias("container"), F.col("reason"), F.lit(None).cast(reports.OUTPUTS).alias("outputs"), "folder_id", "folder_name")
    key = F.concat(F.lit("id:"), F.col("employee_id"))
    rows = items.select(key.alias("key"), "section", F.col("file_name").alias("order"), item.cast(reports.ANY_ITEM).alias("item"))
    rows = rows.unionByName(folders.select(key.alias("key"), F.lit("excluded_folders").alias("section"), F.col("folder_name").alias("order"), gone.cast(reports.ANY_ITEM).alias("item")))
    people = employees.select(key.alias("key"), F.struct("employee", "employee_id").alias("place"), "employee", "employee_id")
    path = os.path.join(out, "manifest.json")
    os.makedirs(out, exist_ok=True)
    document = sinks.write_report(ledger.nested(people, rows), root, path)
    for df in held:
        df.unpersist()
    LOG.info("%d employees, %d files", document["employee_count"], sum(e["counts"]["included"] for e in document["employees"]))
    return path


def run_manifest(spark: SparkSession, manifest_path: str, files_dir: str, out: str, report_path: str, batch: int = BATCH) -> dict:
    """Parse the manifest's files that have no result yet and merge what came of them into the report.

    A file's content is ``<file_id>.pdf`` or ``.txt`` in `files_dir` or below it. Files are taken in batches, in the
    manifest's order, and the report is written after each: a run that is killed goes on after its last batch.
    """
    if not os.path.isabs(report_path):
        report_path = os.path.join(out, report_path)
    os.makedirs(out, exist_ok=True)
    manifest = reports.read_manifest(spark, manifest_path).persist()
    people, listed = reports.employees_of(manifest), reports.items_of(manifest)
    employees, items = _merged_report(spark, people, listed, report_path)
    candidates = listed.where("section = 'included'").join(people, "seq").select("seq", "pos", "employee", "employee_id", "file_id", F.col("item.file_name").alias("file_name"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy("seq", "pos")) - 1  # of files that one document lists
    left = ledger.to_do(candidates, ledger.done_ids(items)).withColumn("batch", F.floor(place / batch)).persist()
    n = left.count()
    document = sinks.write_report(ledger.nested(employees, items), manifest.first()["root_id"], report_path) if not n else {}
    texts = texts_of(spark, files_dir).select(documents.stem(F.col("doc_id")).alias("file_id"), "text", F.col("error").alias("unread")) if n else None
    for k in range(-(-n // batch)):
        employees, items = _merged_report(spark, people, listed, report_path)
        document = _run_batch(left.where(F.col("batch") == k), texts, employees, items, manifest.first()["root_id"], out, report_path)
        LOG.info("%d of %d files", min(n, (k + 1) * batch), n)
    left.unpersist()
    manifest.unpersist()
    return document


def _merged_report(spark: SparkSession, people: DataFrame, listed: DataFrame, report_path: str) -> tuple[DataFrame, DataFrame]:
    """The manifest's employees and items with those of the report as it is now."""
    old = reports.read_report(spark, report_path)
    newer = old.where("employees is not null").count() > 0
    before = (reports.employees_of(old), reports.items_of(old)) if newer else ledger.legacy_report(reports.legacy_files_of(old))
    return ledger.merge(people, listed, *before)


def _run_batch(left: DataFrame, texts: DataFrame, employees: DataFrame, items: DataFrame, root_id: str | None, out: str, report_path: str) -> dict:
    """Parse the files of `left`, write their tables and the report with their results."""
    found = left.withColumn("doc_id", F.concat_ws("/", "seq", "pos")).join(texts, "file_id", "left").persist()
    parsed = timesheet.parse_documents(found.where("text is not null")).persist()
    result = ledger.outcome(parsed, found.select("doc_id", "employee", "employee_id", "file_id", "file_name", "unread"), os.path.abspath(out)).persist()
    placed = parsed.join(result.select("doc_id", F.regexp_replace(F.col("outputs.days_csv"), "/days[.]csv$", "").alias("folder")), "doc_id")
    sinks.write_documents(placed, F.col("folder")).count()
    none = F.lit(None).cast("string")
    item = F.struct("file_id", "file_name", none.alias("mimeType"), none.alias("container"), "reason", "outputs", none.alias("folder_id"), none.alias("folder_name")).cast(reports.ANY_ITEM)
    new = result.join(found.select("doc_id", "seq", "pos"), "doc_id").select(F.col("seq").alias("of"), "pos", "status", "employee", "employee_id", "file_id", item.alias("item"))
    new_people = new.select(F.col("of").alias("seq"), "employee", "employee_id").distinct()
    new_items = new.select(F.col("of").alias("seq"), F.when(F.col("status") == "success", "included").otherwise("skipped").alias("section"), "pos", "file_id", "item")
    document = sinks.write_report(ledger.nested(*_append(employees, items, new_people, new_items)), root_id, report_path)
    for df in (result, parsed, found):
        df.unpersist()
    return document


def _append(employees: DataFrame, items: DataFrame, people: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A run's items after those that were there. The run's employees are the manifest's, so their keys exist."""
    keys = ledger.keyed(people).select("seq", "key")
    late = new.join(keys, "seq").select("key", "section", F.struct(F.lit(2).alias("step"), F.col("seq").cast("long").alias("seq"), F.col("pos").cast("long").alias("pos")).alias("order"), F.lit(1).alias("occurrence"), "file_id", "item")
    files = items.where("section <> 'excluded_folders'")
    from pyspark.sql import Window

    twin = F.row_number().over(Window.partitionBy("key", "section", "item.file_id").orderBy("order"))
    there = files.select("key", "section", "order", twin.alias("occurrence"), F.col("item.file_id").alias("file_id"), "item")
    return employees, ledger.upsert(there.unionByName(late)).unionByName(items.where("section = 'excluded_folders'"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="orolog")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("--workers", default="*", help="local cores")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("parse", help="documents to tables")
    a.add_argument("--input", required=True)
    a.add_argument("--out", required=True)
    a = sub.add_parser("catalog-scan", help="a listing table to a manifest")
    a.add_argument("--listing", required=True, help="a folder (root: 'root'), or Parquet or JSON lines: id, parent_id, name, mime_type, trashed")
    a.add_argument("--root", required=True)
    a.add_argument("--out", default="scan")
    a.add_argument("--terms", help="terms that exclude files and folders, comma-separated, in order (default: those built in; OROLOG_TERMS if set)")
    a = sub.add_parser("run-manifest", help="parse a manifest's files that have no result yet")
    a.add_argument("--manifest", required=True)
    a.add_argument("--files", required=True)
    a.add_argument("--out", default="downloads")
    a.add_argument("--report", default="report.json")
    a.add_argument("--batch", type=int, default=BATCH, help="files after which the report is written")
    a = sub.add_parser("index", help="the PDFs of a match index, in order")
    a.add_argument("--json", required=True)
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, format="%(levelname)s %(message)s")
    spark = local_session(args.workers)
    if args.command == "parse":
        return 1 if parse(spark, args.input, args.out) else 0
    if args.command == "catalog-scan":
        table = listing_table(spark, args.listing)
        terms = args.terms if args.terms is not None else os.environ.get("OROLOG_TERMS")
        print(catalog_scan(spark, table, args.root, args.out, None if terms is None else [t.strip() for t in terms.split(",") if t.strip()]))
        return 0
    if args.command == "run-manifest":
        document = run_manifest(spark, args.manifest, args.files, args.out, args.report, args.batch)
        print(json.dumps({"employees": document["employee_count"], "included": sum(e["counts"]["included"] for e in document["employees"])}))
        return 0
    rows = listing.pdf_matches(reports.read_index(spark, args.json)).collect()  # one person's files
    if not rows:
        raise SystemExit(f"{args.json} lists no PDF")
    for i, r in enumerate(rows, 1):
        print(f"{i} of {len(rows)}: {r['shown']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
